"""Loose structured input: model answers, free-form maps, contracts, publishing text."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from plumbline import constants as K
from plumbline.functions import text as X

# ── contracts ──────────────────────────────────────────────────────────────
# Field -> rule. kind: s string, i integer, i? integer or null,
# b boolean, a array of strings. Further keys: enum, lo, hi, most, optional.
CONTRACTS: dict[str, dict[str, dict]] = {
    "facts": {
        "id": {"kind": "s"}, "verbatim_quote": {"kind": "s"}, "value": {"kind": "s"}, "unit": {"kind": "s"},
        "claim_summary": {"kind": "s"}, "tags": {"kind": "a", "enum": K.FACT_TAGS},
        "procurement_significance": {"kind": "i", "lo": 1, "hi": 5}, "citation_marker": {"kind": "i?"},
    },
    "script": {
        "beat": {"kind": "s", "enum": [b for b, _, _ in K.BEAT_TEMPLATE]}, "narration": {"kind": "s"},
        "fact_ids": {"kind": "a"}, "card_text": {"kind": "s"}, "broll_wish": {"kind": "s"},
        "diagram_labels": {"kind": "a", "most": 4, "optional": True},
    },
    "critique": {
        "actionable_score": {"kind": "i", "lo": 0, "hi": 10}, "coherence_score": {"kind": "i", "lo": 0, "hi": 10},
        "reason_score": {"kind": "i", "lo": 0, "hi": 10}, "revise_notes": {"kind": "s"},
    },
    "match": {
        "score": {"kind": "i", "lo": 0, "hi": 10}, "reason": {"kind": "s"},
        "focal_hint": {"kind": "s", "enum": ["center", "left", "right", "top", "bottom"]},
    },
    "verdict": {
        "match_score": {"kind": "i", "lo": 0, "hi": 10}, "legible": {"kind": "b"}, "issues": {"kind": "a"},
    },
}
# Contracts whose answer is a list under one key, and its length.
LISTED = {"facts": ("facts", None), "script": ("beats", 5)}


def _type_of(v: Column) -> Column:
    return F.schema_of_variant(v)


def _problems(obj: Column, rules: dict[str, dict]) -> Column:
    """array<string> of 'where: why' for one variant object."""
    out = []
    for name, r in rules.items():
        v = F.try_variant_get(obj, f"$.{name}", "variant")
        kind, t = r["kind"], _type_of(v)
        missing = v.isNull()
        ok = {"s": t == "STRING", "b": t == "BOOLEAN", "i": t == "BIGINT", "i?": t.isin("BIGINT", "VOID"),
              "a": F.rlike(t, F.lit(r"^ARRAY<(STRING|VOID)>$"))}[kind]
        checks = [F.when(missing, f"{name}: required") if not r.get("optional") else F.lit(None).cast("string"),
                  F.when(~missing & ~ok, f"{name}: wrong type")]
        if "lo" in r:
            n = F.try_variant_get(obj, f"$.{name}", "bigint")
            checks.append(F.when(~missing & ok & ~n.between(r["lo"], r["hi"]), f"{name}: out of range"))
        if "enum" in r:
            got = F.try_variant_get(obj, f"$.{name}", "array<string>" if kind == "a" else "string")
            odd = F.exists(got, lambda x: ~x.isin(*r["enum"])) if kind == "a" else ~got.isin(*r["enum"])
            checks.append(F.when(~missing & ok & odd, f"{name}: not allowed"))
        if "most" in r:
            size = F.size(F.try_variant_get(obj, f"$.{name}", "array<string>"))
            checks.append(F.when(~missing & ok & (size > r["most"]), f"{name}: too many"))
        out += checks
    keys = F.map_keys(F.try_variant_get(obj, "$", "map<string,variant>"))
    extra = F.transform(F.array_except(keys, X.strings(list(rules))), lambda k: F.concat(k, F.lit(": unexpected")))
    return F.concat(F.filter(F.array(*out), lambda p: p.isNotNull()), extra)


def contract_problems(raw, contract: str) -> Column:
    """array<string> of everything wrong with a JSON answer; empty means valid."""
    rules = CONTRACTS[contract]
    top = F.try_parse_json(X._col(raw))
    none = X.strings([])
    if contract not in LISTED:
        shape = F.when(top.isNull() | ~F.startswith(_type_of(top), F.lit("OBJECT")), F.array(F.lit("top level: not an object")))
        return shape.otherwise(_problems(top, rules))
    key, length = LISTED[contract]
    items = F.try_variant_get(top, f"$.{key}", "array<variant>")
    each = F.flatten(F.transform(items, lambda o, i: F.transform(
        F.when(F.startswith(_type_of(o), F.lit("OBJECT")), _problems(o, rules)).otherwise(F.array(F.lit("not an object"))),
        lambda p: F.concat(F.lit(f"{key}/"), i.cast("string"), F.lit("/"), p))))
    extra = F.array_except(F.map_keys(F.try_variant_get(top, "$", "map<string,variant>")), X.strings([key]))
    wrong_len = F.when(F.size(items) != length, F.array(F.lit(f"{key}: wrong number of items"))).otherwise(none) if length else none
    return (F.when(top.isNull() | ~F.startswith(_type_of(top), F.lit("OBJECT")), F.array(F.lit("top level: not an object")))
            .when(items.isNull(), F.array(F.lit(f"{key}: required")))
            .otherwise(F.concat(wrong_len, F.transform(extra, lambda k: F.concat(k, F.lit(": unexpected"))), each)))


def validate_structured(df: DataFrame, contract: str, raw: str = "raw") -> DataFrame:
    """Rows plus ``problems`` and ``valid``."""
    return df.withColumn("problems", contract_problems(raw, contract)).withColumn("valid", F.size("problems") == 0)


# ── model text ─────────────────────────────────────────────────────────────


def strip_noise(c) -> Column:
    """Fences, escape codes and thought blocks out."""
    c = F.regexp_replace(X._col(c), r"\x1b\[[0-9;?]*[A-Za-z]|\x1b\][^\x07]*\x07", "")
    c = F.regexp_replace(c, r"(?s)<\|channel>thought\n.*?<channel\|>|<\|think\|>.*?<\|/think\|>", "")
    return X.strip(F.regexp_replace(c, r"(?im)^```(?:json)?\s*|\s*```$", ""))


def _blocks(text: str, quoted: bool) -> list[tuple[int, int]]:
    """(begin, end) of every balanced {…} or […] in order of their ends, from one scan; ``quoted`` skips string contents."""
    open_at: dict[str, list[int]] = {"{": [], "[": []}
    out = []
    for m in (K.JSON_MARKS if quoted else K.JSON_BRACKETS).finditer(text):
        mark = m.group()
        if mark in open_at:
            open_at[mark].append(m.start())
        elif mark in ("}", "]"):
            begun = open_at["{" if mark == "}" else "["]
            if begun:
                out.append((begun.pop(), m.end()))
    return out


def _is_json(text: str) -> bool:
    try:
        json.loads(text)
    except json.JSONDecodeError:
        return False
    return True


def _repair(text: str) -> str:
    """The first object, or else array, that no other holds, with the commas mended that models forget or add."""
    text = K.JSON_CONTROL.sub("", text)
    for mark in "{[":
        begin = text.find(mark)
        held = [z for a, z in _blocks(text[begin:], quoted=True) if a == 0] if begin >= 0 else []
        if held:
            text = text[begin:begin + held[0]]
            break
    for pattern, put in K.JSON_COMMAS:
        text = pattern.sub(put, text)
    return text


def _last_object(text: str) -> str | None:
    """The object that ends last after the thinking marker and parses, as one line."""
    text = text.rpartition(K.THINK_END)[2].replace("\n", " ")
    return next((text[a:z] for a, z in reversed(_blocks(text, quoted=False)) if text[a] == "{" and _is_json(text[a:z])), None)


def clean_model_text(df: DataFrame, raw: str = "raw", mode: str = "outermost") -> DataFrame:
    """Adds ``json``: the answer's JSON text, repaired where that is possible.

    Noise is removed by expressions; only the balanced scan runs in Python.
    ``mode``: 'outermost' block, or the 'last' object after thinking.
    """
    pick = _repair if mode == "outermost" else _last_object
    schema = T.StructType([*df.schema.fields, T.StructField("json", T.StringType())])

    def run(batches):
        for pdf in batches:
            pdf["json"] = [None if t is None else pick(t) for t in pdf.pop("_clean")]
            yield pdf

    return df.withColumn("_clean", strip_noise(raw)).mapInPandas(run, schema)


# ── free-form maps and chart series ────────────────────────────────────────
SIGNED = r"(-?\p{Nd}+(?:[.,]\p{Nd}+)?)"


def coerce_number(c) -> Column:
    """First signed number of a text, comma read as decimal point; NULL if none."""
    return F.replace(F.nullif(F.regexp_extract(X._col(c), SIGNED, 1), F.lit("")), F.lit(","), F.lit(".")).try_cast("double")


def title_case(c) -> Column:
    """Capital after every non-letter, small letters elsewhere."""
    return F.aggregate(F.split(F.lower(X._col(c)), ""), F.struct(F.lit("").alias("out"), F.lit(False).alias("in_word")), lambda a, ch: F.struct(
        F.concat(a["out"], F.when(a["in_word"], ch).otherwise(F.upper(ch))).alias("out"), F.rlike(ch, F.lit(r"^\p{L}")).alias("in_word")), lambda a: a["out"])


def _entries(raw) -> Column:
    """array<struct<key,value:variant>> of a JSON object, in the order of the text.

    A variant sorts its keys, so the order comes from a plain map parse and the
    typed values from the variant.
    """
    keys = F.map_keys(F.from_json(X._col(raw), "map<string,string>"))
    typed = F.try_variant_get(F.try_parse_json(X._col(raw)), "$", "map<string,variant>")
    none = F.expr("cast(array() as array<struct<key:string,value:variant>>)")
    return F.coalesce(X.let(typed, lambda m: F.transform(keys, lambda k: F.struct(k.alias("key"), F.try_element_at(m, k).alias("value")))), none)


def _text(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def numeric_pairs(raw) -> Column:
    """array<struct<label,num,raw>> of the numeric entries of a JSON object, in its own order."""
    def row(e):
        scalar = F.rlike(_type_of(e["value"]), F.lit("^(STRING|BIGINT|DOUBLE|FLOAT|DECIMAL.*|BOOLEAN)$"))
        t = F.when(scalar, _text(e["value"]))
        label = title_case(F.trim(F.regexp_replace(e["key"], r"[_\-]+", " ")))
        return F.struct(label.alias("label"), coerce_number(t).alias("num"), t.alias("raw"))

    found = F.transform(_entries(raw), row)
    return F.filter(found, lambda p: p["num"].isNotNull())


SERIES = "struct<labels:array<string>,values:array<string>>"


def chart_series(chart_type, raw) -> Column:
    """labels and values a chart can draw from a loose JSON map; NULL when there is no way."""
    v, kind, pairs = F.try_parse_json(X._col(raw)), X._col(chart_type), numeric_pairs(raw)
    texts = lambda k: F.try_variant_get(v, f"$.{k}", "array<string>")
    one = lambda k: F.try_variant_get(v, f"$.{k}", "string")
    empty = F.lit(None).cast(SERIES)

    def series(labels, values):
        return F.struct(labels.alias("labels"), values.alias("values")).cast(SERIES)

    def nonempty(a):
        return F.coalesce(F.size(a) > 0, F.lit(False))

    def num_text(t):
        return coerce_number(t).cast("string")

    canon = nonempty(texts("labels")) & nonempty(texts("values")) & F.forall(texts("values"), lambda x: coerce_number(x).isNotNull())
    numbered = F.filter(F.transform(_entries(raw), lambda e: F.struct(
        F.regexp_extract(e["key"], r"(?i)^label(\d+)$", 1).try_cast("int").alias("i"), _text(e["value"]).alias("label"),
        _text(F.try_element_at(F.try_variant_get(v, "$", "map<string,variant>"), F.concat(F.lit("value"), F.regexp_extract(e["key"], r"(?i)^label(\d+)$", 1)))).alias("v"))),
        lambda p: p["i"].isNotNull() & coerce_number(p["v"]).isNotNull())
    numbered = F.array_sort(numbered)
    bar = (F.when(canon, series(F.slice(texts("labels"), F.lit(1), F.size(texts("values"))), F.transform(texts("values"), num_text)))
           .when(F.size(numbered) >= 2, series(F.transform(numbered, lambda p: p["label"]), F.transform(numbered, lambda p: num_text(p["v"]))))
           .when(F.size(pairs) >= 2, series(F.transform(pairs, lambda p: p["label"]), F.transform(pairs, lambda p: p["num"].cast("string")))))
    given = F.coalesce(F.nullif(one("value"), F.lit("")), F.nullif(one("value1"), F.lit("")), F.nullif(one("stat"), F.lit("")))
    named = F.coalesce(F.nullif(one("label"), F.lit("")), F.nullif(one("unit"), F.lit("")), F.nullif(one("description"), F.lit("")), F.lit(""))
    p0 = F.get(pairs, F.lit(0))
    stat = (F.when(coerce_number(given).isNotNull(), series(F.array(named), F.array(given)))
            .when(F.size(pairs) > 0, series(F.array(p0["label"]), F.array(p0["raw"]))))
    p1 = F.get(pairs, F.lit(1))
    both = F.try_variant_get(v, "$.left_value", "variant").isNotNull() & F.try_variant_get(v, "$.right_value", "variant").isNotNull()
    versus = (F.when(both, series(F.array(F.coalesce(one("left_label"), F.lit("")), F.coalesce(one("right_label"), F.lit(""))), F.array(one("left_value"), one("right_value"))))
              .when(F.size(pairs) >= 2, series(F.array(p0["label"], p1["label"]), F.array(p0["raw"], p1["raw"]))))
    flow = F.when(nonempty(texts("steps")), series(texts("steps"), X.strings([])))
    line = F.when(nonempty(texts("x")) & nonempty(texts("y")), series(texts("x"), texts("y")))
    return (F.when(kind == "bar", bar).when(kind == "callout_stat", stat).when(kind == "comparison", versus)
            .when(kind == "flow", flow).when(kind == "line", line).otherwise(empty))


# ── dimensions and choices ─────────────────────────────────────────────────
def lookup(c, table: dict[str, str], default: str) -> Column:
    """Small fixed map as one expression, with a default."""
    m = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(F.try_element_at(m, X._col(c)), F.lit(default))


def region_dims(region) -> list[Column]:
    return [lookup(region, K.REGION_LANGUAGE, K.REGION_LANGUAGE["default"]).alias("language"),
            lookup(region, K.REGION_TIMEZONE, K.REGION_TIMEZONE["default"]).alias("timezone"),
            lookup(region, K.REGION_VOICE, K.REGION_VOICE["default"]).alias("voice"),
            lookup(F.lower(X._col(region)), K.CAPTION_LANGUAGE, "en").alias("caption_language")]


def prosody(beat) -> Column:
    return lookup(beat, K.PROSODY_BY_BEAT, "conversational")


def enum_or_default(scenes: DataFrame, choices: DataFrame, on: Sequence[str] = ("run_id", "pos")) -> DataFrame:
    """Take a model's choice only where it is allowed; ``applied`` says whether any was taken."""
    fields = list(K.ALLOWED_CHOICES)
    c = choices.select(*on, *[F.col(f).alias(f"_{f}") for f in fields])
    out = scenes.join(c, list(on), "left")
    ok = {f: F.coalesce(F.col(f"_{f}").isin(*K.ALLOWED_CHOICES[f]), F.lit(False)) for f in fields}
    applied = F.lit(False)
    for f in fields:
        applied = applied | ok[f]
    keep = [c for c in scenes.columns if c not in fields]
    return out.select(*keep, *[F.when(ok[f], F.col(f"_{f}")).otherwise(F.col(f)).alias(f) for f in fields], applied.alias("applied"))


# ── publishing text ────────────────────────────────────────────────────────
def publish_title(region, category, claim) -> Column:
    r = F.initcap(F.replace(F.coalesce(X._col(region), F.lit("")), F.lit(" "), F.lit("\u0001")))
    r = F.replace(r, F.lit("\u0001"), F.lit(" "))
    cat = title_case(F.replace(F.coalesce(X._col(category), F.lit("")), F.lit("_"), F.lit(" ")))
    hook = X.strip_chars(X.first_words(F.coalesce(X._col(claim), F.lit("")), 10), ".,!?")
    text = (F.when((r != "") & (cat != "") & (hook != ""), F.concat(r, F.lit(" "), cat, F.lit(": "), hook))
            .when((cat != "") & (hook != ""), F.concat(cat, F.lit(": "), hook)).when(hook != "", hook).otherwise(K.DEFAULT_TITLE))
    clean = X.remove_phrases(F.left(text, F.lit(K.TITLE_MAX)))
    return F.when(clean == "", K.DEFAULT_TITLE).otherwise(clean)


def publish_description(stat, claim, region, category, site: str) -> Column:
    s, c = F.coalesce(X._col(stat), F.lit("")), F.coalesce(X._col(claim), F.lit(""))
    tag = lambda x: F.concat(F.lit("#"), F.replace(F.lower(X._col(x)), F.lit("_"), F.lit("")))
    text = F.concat(F.when(s != "", F.concat(F.lit("Key insight: "), s, F.lit("\n"))).otherwise(""),
                    F.when(c != "", F.concat(X.strip(F.left(c, F.lit(80))), F.lit("\n"))).otherwise(""),
                    F.lit(f"\nLearn more: {site}/\n"), F.lit("#Shorts #ChemicalEngineering "), tag(region), F.lit(" "), tag(category))
    out = X.remove_phrases(F.left(text, F.lit(K.DESCRIPTION_MAX)))

    def ensure(t, needle, addition):
        return F.when(~F.contains(t, F.lit(needle)) & (F.length(t) + len(addition) <= K.DESCRIPTION_MAX), F.concat(t, F.lit(addition))).otherwise(t)

    return X.let(out, lambda t: X.let(ensure(t, site, f"\nLearn more: {site}/"), lambda u: ensure(u, "#Shorts", "\n\n#Shorts #ChemicalEngineering")))


def publish_tags(region, category, subcategory) -> Column:
    plain = lambda x: F.lower(F.replace(X._col(x), F.lit("_"), F.lit(" ")))
    has = lambda x: F.coalesce(X._col(x), F.lit("")) != ""
    tags = F.array(F.when(has(region), F.lower(X._col(region))), F.when(has(category), plain(category)),
                   F.when(has(subcategory) & ~X._col(subcategory).eqNullSafe(X._col(category)), plain(subcategory)), *[F.lit(t) for t in K.EXTRA_TAGS])
    return F.transform(F.slice(F.filter(tags, lambda t: t.isNotNull()), 1, K.MAX_TAGS), X.squeeze)
