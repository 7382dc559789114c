"""Small text builders for the oracle SQL (plain strings, no parsing)."""

from __future__ import annotations

from plumbline import constants as K


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def lits(items) -> str:
    return "[" + ", ".join(lit(i) for i in items) + "]"


def in_list(items) -> str:
    return "(" + ", ".join(lit(i) for i in items) + ")"


def strip(c: str) -> str:
    return f"regexp_replace({c}, {lit(f'^{K.WS}+|{K.WS}+$')}, '', 'g')"


def words(c: str) -> str:
    return f"list_filter(string_split_regex({c}, {lit(K.WS + '+')}), lambda w: w <> '')"


def norm(c: str) -> str:
    inner = f"replace({c}, '&nbsp;', ' ')"
    inner = f"lower(translate({inner}, {lit(K.MATCH_FROM)}, {lit(K.MATCH_TO)}))"
    return f"trim(regexp_replace({inner}, {lit(K.WS + '+')}, ' ', 'g'), ' ')"


def sentences(c: str) -> str:
    cut = (f"regexp_replace({c}, {lit('([.!?])' + K.WS + '+([A-Z“\"(])')}, "
           "'\\1' || chr(1) || '\\2', 'g')")
    return (f"list_filter(list_transform(string_split({cut}, chr(1)), "
            f"lambda s: {strip('s')}), lambda s: s <> '')")


def numbers(c: str) -> str:
    return (f"list_transform(regexp_extract_all({c}, "
            r"'\p{Nd}[\p{Nd},]*(?:\.\p{Nd}+)?'), lambda t: replace(t, ',', ''))")


def tokens_alpha(c: str, stop) -> str:
    return (f"list_distinct(list_filter(list_transform(regexp_extract_all({c}, "
            f"'[A-Za-z][A-Za-z0-9]+'), lambda t: lower(t)), lambda t: length(t) > 2 "
            f"AND t NOT IN {in_list(stop)}))")
