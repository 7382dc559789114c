"""Column functions over text. All of them stay on the JVM side."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from plumbline import constants as K

NUMBER = r"(\p{Nd}[\p{Nd},]*(?:\.\p{Nd}+)?)"
STAT_NUMBER = r"(\p{Nd}+(?:[.,]\p{Nd}+)?)"
SENTENCE_BREAK = f"(?<=[.!?]){K.WS}+(?=[A-Z“\"(])"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also when ``body`` uses it inside a lambda."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strings(items: Sequence[str]) -> Column:
    return F.array(*[F.lit(i) for i in items]) if items else F.expr("cast(array() as array<string>)")


def strip(c) -> Column:
    """Cut white space from both ends."""
    return F.regexp_replace(_col(c), f"^{K.WS}+|{K.WS}+$", "")


def strip_chars(c, chars: str) -> Column:
    """Cut any of ``chars`` from both ends (``chars`` as a regex class body)."""
    return F.regexp_replace(_col(c), f"^[{chars}]+|[{chars}]+$", "")


def squeeze(c) -> Column:
    return strip(F.regexp_replace(_col(c), K.WS + "+", " "))


def words(c) -> Column:
    return F.filter(F.split(_col(c), K.WS + "+"), lambda w: w != "")


def word_count(c) -> Column:
    # found, not split: a split compiles its pattern anew for every row
    return F.size(F.regexp_extract_all(_col(c), F.lit(f"[{K.NOT_WS}]++"), F.lit(0)))


def first_words(c, n) -> Column:
    n = F.lit(n) if isinstance(n, int) else n
    return F.array_join(F.slice(words(c), F.lit(1), n), " ")


def normalize_for_match(c) -> Column:
    """Fold spaces, dashes, quotes and case so that two spellings compare equal."""
    c = F.replace(_col(c), F.lit("&nbsp;"), F.lit(" "))
    c = F.lower(F.translate(c, K.MATCH_FROM, K.MATCH_TO))
    return F.trim(F.regexp_replace(c, K.WS + "+", " "))


def locate_in(quote_norm, text_norm) -> Column:
    """0-based offset of one normalised text in another, NULL if blank or absent."""
    q, t = _col(quote_norm), _col(text_norm)
    return F.when((q != "") & F.contains(t, q), F.call_function("locate", q, t) - 1)


def sentence_array(c) -> Column:
    parts = F.transform(F.split(_col(c), SENTENCE_BREAK, -1), strip)
    return F.filter(parts, lambda s: s != "")


def numeric_sentence_array(c) -> Column:
    """Sentences with a digit, each distinct text once, in first-seen order."""
    return F.array_distinct(F.filter(sentence_array(c), lambda s: F.rlike(s, F.lit(r"\p{Nd}"))))


def numeric_tokens(c) -> Column:
    found = F.regexp_extract_all(F.coalesce(_col(c), F.lit("")), F.lit(NUMBER), F.lit(1))
    return F.transform(found, lambda t: F.replace(t, F.lit(","), F.lit("")))


def stat_numbers(c) -> Column:
    return F.regexp_extract_all(F.coalesce(_col(c), F.lit("")), F.lit(STAT_NUMBER), F.lit(1))


def stat_tokens(c) -> Column:
    """Numbers of 3 or more, or written with a decimal mark."""
    return F.filter(stat_numbers(c), lambda n: F.rlike(n, F.lit("[.,]"))
                    | (F.replace(n, F.lit(","), F.lit(".")).cast("double") >= 3))


def tokens_alpha(c, stop: Sequence[str] = K.STOP_SCORING) -> Column:
    found = F.regexp_extract_all(F.coalesce(_col(c), F.lit("")), F.lit("([A-Za-z][A-Za-z0-9]+)"), F.lit(1))
    return F.array_distinct(F.filter(F.transform(found, F.lower),
                                     lambda t: (F.length(t) > 2) & ~t.isin(*stop)))


def tokens_ws(c, stop: Sequence[str] = K.STOP_LIBRARY) -> Column:
    return F.array_distinct(F.filter(words(F.lower(_col(c))),
                                     lambda t: (F.length(t) > 2) & ~t.isin(*stop)))


QUERY_EDGE = ".,;:!?\"'()"


def keyword_query(c, n: int = 4) -> Column:
    """First content words, case kept."""
    bare = F.transform(words(c), lambda w: strip_chars(w, QUERY_EDGE))
    keep = F.filter(bare, lambda w: (F.length(w) > 2) & ~F.lower(w).isin(*K.STOP_QUERY))
    return F.array_join(F.slice(keep, 1, n), " ")


def topic_default(category) -> Column:
    expr = F.lit(K.TOPIC_FALLBACK)
    for key, text in K.TOPIC_DEFAULTS.items():
        expr = F.when(_col(category) == key, text).otherwise(expr)
    return expr


def build_queries(subject, modifier, narration, category, context: str = K.SEARCH_CONTEXT) -> Column:
    """Ordered, distinct search queries, biased towards the search context."""
    specific = strip(F.concat(_col(subject), F.lit(" "), _col(modifier)))
    raw = F.array(specific, keyword_query(narration), _col(subject), topic_default(category))
    distinct = F.array_distinct(F.filter(raw, lambda q: q != ""))
    industrial = "|".join(K.INDUSTRIAL_TOKENS)
    return F.transform(distinct, lambda q: F.when(F.rlike(F.lower(q), F.lit(industrial)), q)
                       .otherwise(F.concat(q, F.lit(" " + context))))


def normalize_speech(c, domain: str | None = None, spoken_domain: str | None = None) -> Column:
    """Ordered rewrite of a text for reading aloud."""
    rules = list(K.SPEECH_BEFORE_DOMAIN)
    if domain:
        rules.append(("(?i)" + domain.replace(".", r"\."), spoken_domain or domain.replace(".", " dot ")))
    rules += K.SPEECH_AFTER_DOMAIN
    out = _col(c)
    for pattern, repl in rules:
        if re.escape(pattern) == pattern:  # a plain text
            out = F.replace(out, F.lit(pattern), F.lit(repl))
        else:
            out = F.regexp_replace(out, "(?U)" + _led(pattern), repl.replace("\\1", "$1"))
    return squeeze(out)


def _led(pattern: str) -> str:
    """The same pattern, led by a look at its first letter or digit: a word border alone is costly to try at every place."""
    return re.sub(r"^\\b([A-Za-z0-9])(?![?*{])", r"(?=\1)\\b\1", pattern)


def prompt_windows(prompt: str, width: int = 40, step: int = 20) -> list[str]:
    if len(prompt) < width:
        return []
    return [prompt[i:i + width].lower() for i in range(0, max(1, len(prompt) - width), step)]


def any_contains(c, phrases: Sequence[str]) -> Column:
    """True if the text holds one of the phrases; the text is computed once."""
    if not phrases:
        return F.lit(False)

    def found(t):
        out = F.contains(t, F.lit(phrases[0]))
        for p in phrases[1:]:
            out = out | F.contains(t, F.lit(p))
        return out

    return let(_col(c), found)


def description_gate(description, visible_text, prompt: str) -> Column:
    """First reason to distrust a description; NULL when it holds."""
    d, low = _col(description), F.lower(_col(description))
    return (F.when(d.isNull() | (d == ""), "describe_failed")
            .when(F.length(d) < K.DESCRIPTION_MIN_CHARS, "description_too_short")
            .when(any_contains(low, K.REFUSAL_PHRASES), "refusal_phrase")
            .when(any_contains(low, prompt_windows(prompt)), "prompt_echo")
            .when(any_contains(F.lower(F.coalesce(_col(visible_text), F.lit(""))), K.WATERMARK_TERMS),
                  "watermark_text"))


def overlay_text_clean(c) -> Column:
    c = strip(F.regexp_replace(_col(c), r"^\[.*?[\]:]", ""))
    return F.left(squeeze(F.translate(c, ",[]", " ")), F.lit(60))


def overlay_text_flag(text, narration, own_names: Sequence[str] = ()) -> Column:
    """Why an on-screen text is not acceptable; NULL when it is."""
    def bag(c):
        return F.array_distinct(F.transform(words(c), lambda w: strip_chars(F.lower(w), ".,;:!?")))

    t, low = bag(text), F.lower(_col(text))
    voiced = (F.size(t) > 0) & F.arrays_overlap(t, bag(narration)) & (F.size(F.array_except(t, bag(narration))) <= 1)
    related = (F.rlike(_col(text), F.lit(r"\p{Nd}"))
               | F.arrays_overlap(t, strings([*own_names, *K.OVERLAY_TERMS]))
               | F.contains(low, F.lit("vs")) | F.contains(low, F.lit("→")) | F.contains(low, F.lit("->")))
    return (F.when(word_count(text) > 6, "text_too_long")
            .when(voiced, "text_duplicates_voice")
            .when(~related, "text_unrelated"))


def is_non_latin(c) -> Column:
    indic = F.regexp_count(_col(c), F.lit(K.INDIC_LETTER))
    latin = F.regexp_count(_col(c), F.lit("[A-Za-z]"))
    return (indic > 0) & (indic > latin * K.NON_LATIN_SHARE)


def junk_title(c) -> Column:
    """Reason to drop a clip by its title; NULL when none."""
    hit = F.lower(F.regexp_extract(_col(c), "(?iU)" + K.TITLE_REJECT, 1))
    return (F.when(hit != "", F.concat(F.lit("junk_keyword:"), hit))
            .when(is_non_latin(c), "non_latin_script"))


def junk_caption(c) -> Column:
    return F.rlike(_col(c), F.lit("(?iU)" + K.CAPTION_REJECT)) | diagram_caption(c) | is_non_latin(c)


def diagram_caption(c) -> Column:
    return F.rlike(_col(c), F.lit("(?iU)" + K.DIAGRAM_REJECT))


def parse_runtime(c) -> Column:
    """'MM:SS' or 'HH:MM:SS' to seconds; NULL when it is neither."""
    p = F.split(strip(c), ":")
    def whole(i):
        return strip(F.get(p, F.lit(i))).try_cast("int").cast("double")
    def real(i):
        return strip(F.get(p, F.lit(i))).try_cast("double")
    return (F.when(F.size(p) == 2, whole(0) * 60 + real(1))
            .when(F.size(p) == 3, whole(0) * 3600 + whole(1) * 60 + real(2)))


def trim_quote(c, limit: int = 120) -> Column:
    """Squeeze, and cut a long quote at its last space before ``limit``."""
    q = squeeze(c)
    head = F.left(q, F.lit(limit))
    cut = F.regexp_replace(F.regexp_replace(head, "(?s) [^ ]*$", ""), "[.,;: ]+$", "")
    return F.when(F.length(q) <= limit, q).otherwise(F.concat(cut, F.lit("…")))


def pick_accent(c) -> Column:
    """The first number, else the longest word (the first of equals)."""
    number = F.regexp_extract(_col(c), NUMBER, 1)
    bare = F.transform(words(c), lambda w: strip_chars(w, ".,;:!?"))
    longest = F.aggregate(bare, F.lit(""), lambda a, w: F.when(F.length(w) > F.length(a), w).otherwise(a))
    return F.when(number != "", number).otherwise(longest)


def remove_phrases(c, phrases: Sequence[str] = K.SCRIPT_BANNED_PHRASES) -> Column:
    out = _col(c)
    for p in phrases:
        out = F.regexp_replace(out, "(?iu)" + "".join("\\" + x if not x.isalnum() and x != " " else x for x in p), " ")
    return squeeze(out)


def strip_tags(c) -> Column:
    return F.regexp_replace(F.coalesce(_col(c), F.lit("")), "<[^>]+>", "")


UNIT_NUMBER = (
    r"(?U)\b\d+(?:[.,]\d+)?\s*(?:%|(?i:mg/L\b|kg(?:/t)?\b|(?:hours?|days?|years?)\b|"
    r"(?:degrees?\s*C|°C)\b|(?:ppm|tonnes?)\b))"
)


#: The same matches, found faster: digits are looked for before word borders.
UNIT_SCAN = UNIT_NUMBER.replace(r"\b", r"(?=\d)\b", 1)


def _unit_value(match) -> Column:
    return F.regexp_extract(match, r"(?U)^(\d+(?:[.,]\d+)?)", 1)


def _unit_name(match) -> Column:
    unit = F.regexp_replace(match, r"(?U)^\d+(?:[.,]\d+)?\s*", "")
    return F.when(F.rlike(unit, F.lit(r"(?iU)^(?:degrees?\s*C|°C)$")), F.lit("C")).otherwise(unit)


def unit_numerics(c) -> Column:
    """array<struct<value,unit,match,start>>: numbers with a unit, left to right.

    The six unit families cannot match overlapping text at different starts, so
    one alternation finds the same set as six scans; offsets come from the
    lengths of the text between matches.
    """
    text = F.coalesce(_col(c), F.lit(""))
    found = F.regexp_extract_all(text, F.lit(UNIT_SCAN), F.lit(0))
    gaps = F.slice(F.split(text, UNIT_SCAN, -1), F.lit(1), F.size(found))
    start = F.struct(F.lit(0).alias("at"),
                     F.expr("cast(array() as array<struct<value:string,unit:string,match:string,start:int>>)").alias("out"))

    def step(acc, pair):
        m, begin = pair["m"], acc["at"] + F.length(pair["gap"])
        row = F.struct(_unit_value(m).alias("value"), _unit_name(m).alias("unit"), m.alias("match"), begin.alias("start"))
        return F.struct((begin + F.length(m)).alias("at"), F.concat(acc["out"], F.array(row)).alias("out"))

    pairs = F.arrays_zip(gaps.alias("gap"), found.alias("m"))
    return F.aggregate(pairs, start, step, lambda acc: acc["out"])


def sentence_facts(c, claim_chars: int | None = None) -> Column:
    """array<struct<value,unit,claim>>, one per distinct (sentence, match); ``claim_chars`` shortens what is shown only.

    Matches are those of ``unit_numerics``, whose offsets nobody reads here.
    """
    sents = F.array_distinct(F.regexp_extract_all(strip_tags(c), F.lit(f"{K.WS}*+([^.!?]*[.!?])"), F.lit(1)))

    def facts(s):
        claim = s if claim_chars is None else F.left(s, F.lit(claim_chars))
        return F.transform(F.array_distinct(F.regexp_extract_all(s, F.lit(UNIT_SCAN), F.lit(0))), lambda m: F.struct(
            _unit_value(m).alias("value"), _unit_name(m).alias("unit"), claim.alias("claim")))

    return F.flatten(F.transform(sents, facts))


def is_grounded(claim, facts_text, article, context_chars: int | None = None) -> Column:
    """A claim stands if one of its numbers and one of its long words occur in the context.

    ``context_chars`` limits the article part; None reads the whole article.
    """
    body = _col(article) if context_chars is None else F.left(_col(article), F.lit(context_chars))
    ctx = F.lower(F.concat(_col(facts_text), F.lit(" "), body))
    nums = stat_numbers(claim)
    long_words = F.transform(F.filter(words(claim), lambda w: F.length(w) > 5),
                             lambda w: strip_chars(F.lower(w), r".,;:%()\[\]"))
    found = let(ctx, lambda c: F.exists(nums, lambda n: F.contains(c, n))
                & ((F.size(long_words) == 0) | F.exists(long_words, lambda w: F.contains(c, w))))
    return (F.size(nums) > 0) & found


# ── timing helpers on one text ─────────────────────────────────────────────
def estimate_s(c) -> Column:
    return word_count(c) / F.lit(K.WORDS_PER_SECOND)


#: What stands between marks, from its first character that is not white space to its last one.
_PHRASE = f"[{K.NOT_WS_OR_MARK}](?:[^,.;:]*[{K.NOT_WS_OR_MARK}])?"


def split_phrases(c) -> Column:
    return F.regexp_extract_all(_col(c), F.lit(_PHRASE), F.lit(0))


def _pieces(phrases) -> Column:
    """array<struct<text,n>>: phrases with their word counts; long ones cut into pieces of a few words."""
    size = max(1, int(K.SHOT_TARGET_MAX_S * K.WORDS_PER_SECOND))
    run = f"[{K.NOT_WS}]++(?:{K.WS}++[{K.NOT_WS}]++){{0,{size - 1}}}"

    def pieces(p):
        """One for a short phrase, as it stands; runs of ``size`` words of a long one, a single space between them."""
        one = lambda text: F.struct(text.alias("text"), word_count(text).alias("n"))
        return let(F.regexp_extract_all(p, F.lit(run), F.lit(0)), lambda runs: F.when(F.size(runs) > 1, F.transform(
            runs, lambda r: one(F.regexp_replace(r, K.WS + "+", " ")))).otherwise(F.array(one(p))))

    return F.flatten(F.transform(_col(phrases), pieces))


def chunk_long(phrases) -> Column:
    """Cut phrases that would last too long into pieces of a few words."""
    return F.transform(_pieces(phrases), lambda p: p["text"])


def marked(items, zero: Column, rule) -> Column:
    """Positions (from 0) of the array items that one fold marks; ``rule(state, item, position)`` gives (mark, next state).

    Marks are bits of a few words, so the fold does not copy what it has found at every step: linear in long arrays.
    """
    def step(acc, x):
        mark, state = rule(acc["state"], x, acc["at"])
        k = F.pmod(acc["at"], F.lit(62))
        bits = acc["bits"].bitwiseOR(F.when(mark, F.call_function("shiftleft", F.lit(1).cast("bigint"), k)).otherwise(F.lit(0).cast("bigint")))
        return let(bits, lambda b: F.struct(state.alias("state"), (acc["at"] + 1).alias("at"), F.when(k == 61, F.lit(0).cast("bigint")).otherwise(b).alias("bits"),
                                            F.when(k == 61, F.array_append(acc["words"], b)).otherwise(acc["words"]).alias("words")))

    def positions(acc):
        words = lambda i: F.coalesce(F.get(acc["words"], F.floor(i / 62).cast("int")), acc["bits"])
        found = F.filter(F.sequence(F.lit(0), F.greatest(acc["at"] - 1, F.lit(0))), lambda i: F.call_function("shiftright", words(i), F.pmod(i, F.lit(62))).bitwiseAND(F.lit(1).cast("bigint")) == 1)
        return F.when(acc["at"] > 0, found).otherwise(F.expr("cast(array() as array<int>)"))

    start = F.struct(zero.alias("state"), F.lit(0).alias("at"), F.lit(0).cast("bigint").alias("bits"), F.expr("cast(array() as array<bigint>)").alias("words"))
    return F.aggregate(_col(items), start, step, positions)


def pack_phrases(phrases) -> Column:
    """Greedy packing of phrases into spans of up to the target length. A last span that is too short joins the one before.

    One fold over word counts: it grows the spans themselves for a text of few pieces; for a longer one, where that would
    copy all spans at each new one, it marks where spans begin, then each is joined from its own pieces.
    """
    def secs(n):
        return n / F.lit(K.WORDS_PER_SECOND)

    return let(_pieces(phrases), lambda ps: F.when(F.size(ps) <= FEW_PIECES, _packed_few(ps, secs)).otherwise(_packed_many(ps, secs)))


#: Up to so many pieces spans are grown in place.
FEW_PIECES = 64


def _packed_few(ps: Column, secs) -> Column:
    def step(a, p):
        n = a["n"] + p["n"]  # none before the first piece
        return F.when(n.isNull(), F.struct(a["done"].alias("done"), p["text"].alias("now"), p["n"].alias("n"))).when(
            secs(n) > K.SHOT_TARGET_MAX_S, F.struct(F.array_append(a["done"], a["now"]).alias("done"), p["text"].alias("now"), p["n"].alias("n"))).otherwise(
            F.struct(a["done"].alias("done"), F.concat_ws(", ", a["now"], p["text"]).alias("now"), n.alias("n")))

    def end(a):
        done, k = a["done"], F.size(a["done"])
        return F.when(a["n"].isNull(), done).when((k > 0) & (secs(a["n"]) < K.SHOT_TARGET_MIN_S / 2), F.concat(
            F.slice(done, F.lit(1), k - 1), F.array(F.concat_ws(", ", F.element_at(done, -1), a["now"])))).otherwise(F.array_append(done, a["now"]))

    return F.aggregate(ps, F.expr("cast(named_struct('done', array(), 'now', null, 'n', null) as struct<done:array<string>,now:string,n:int>)"), step, end)


def _packed_many(ps: Column, secs) -> Column:
    def rule(n, p, at):
        begins = (at == 0) | (secs(n + p["n"]) > K.SHOT_TARGET_MAX_S)
        return begins, F.when(begins, p["n"]).otherwise(n + p["n"])

    def whole(at):
        """Without the last beginning, if little follows it."""
        last = F.aggregate(F.filter(ps, lambda p, i: i >= F.element_at(at, -1)), F.lit(0), lambda n, p: n + p["n"])
        return F.when((F.size(at) > 1) & (secs(last) < K.SHOT_TARGET_MIN_S / 2), F.slice(at, 1, F.greatest(F.size(at) - 1, F.lit(0)))).otherwise(at)

    span = lambda s, e: F.array_join(F.transform(F.sequence(s, e - 1), lambda k: F.get(ps, k)["text"]), ", ")
    return let(marked(ps, F.lit(0), rule), lambda found: let(whole(found), lambda at: F.transform(
        at, lambda s, i: span(s, F.coalesce(F.get(at, i + 1), F.size(ps))))))


def srt_time(seconds, rounded: bool = True) -> Column:
    """HH:MM:SS,mmm; milliseconds half-even rounded, or cut off."""
    s = F.greatest(_col(seconds), F.lit(0.0)) if not rounded else _col(seconds)
    ms = (F.rint(s * 1000) if rounded else F.floor(F.rint(s * 1000000) / 1000)).cast("long")
    return F.format_string("%02d:%02d:%02d,%03d", F.floor(ms / 3600000), F.floor(ms % 3600000 / 60000),
                           F.floor(ms % 60000 / 1000), ms % 1000)


def ass_time(seconds) -> Column:
    """H:MM:SS.cc"""
    s = _col(seconds)
    return F.concat(F.floor(s / 3600).cast("string"), F.lit(":"),
                    F.lpad(F.floor((s % 3600) / 60).cast("string"), 2, "0"), F.lit(":"),
                    F.format_string("%05.2f", s % 60))


def truncate_words(c, seconds) -> Column:
    limit = F.greatest(F.lit(8), F.bround(_col(seconds) * 2.5).cast("int"))
    return F.when(word_count(c) > limit, first_words(c, limit)).otherwise(strip(c))


def reveal_count(n, stage, total) -> Column:
    s = F.greatest(F.lit(1), F.least(_col(stage), _col(total)))
    return F.ceil(_col(n) * s / _col(total))
