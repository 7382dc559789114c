"""Mining numeric facts and proving each one verbatim against its source."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from plumbline.functions import text as X
from plumbline.session import cut, dealt

SHINGLE = 4


def mine_numeric_sentences(df: DataFrame, cap: int | None = None, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, pos, sentence): distinct numeric sentences in document order.

    Split, filter and de-duplication run inside each row, so the job is one
    scan without a shuffle, whatever the number of documents.
    """
    found = X.numeric_sentence_array(text)
    if cap is not None:
        found = F.slice(found, 1, cap)
    return df.where(F.rlike(text, F.lit(r"\p{Nd}"))).select(id, F.posexplode(found).alias("p", "sentence")).select(
        id, F.col("p").cast("bigint").alias("pos"), "sentence")


def locate_verbatim(facts: DataFrame, docs: DataFrame, on: str = "doc_id", quote: str = "quote", text: str = "text") -> DataFrame:
    """Facts with ``char_offset`` of the quote in their own document, NULL if absent."""
    d = docs.select(on, X.normalize_for_match(text).alias("_text"))
    f = facts.withColumn("_quote", X.normalize_for_match(quote))
    return f.join(d, on, "left").withColumn("char_offset", X.locate_in("_quote", "_text")).drop("_text", "_quote")


def _word_keys(words: str, n: int) -> Column:
    """Hashes of the shingles of ``n`` words of an array column, in order."""
    count = F.size(words) - (n - 1)
    shingle = lambda i: [F.get(words, i + k) for k in range(n)]
    return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.xxhash64(F.lit(n), *shingle(i)))).otherwise(F.array().cast("array<bigint>"))


def _char_keys(c: str, n: int) -> Column:
    """Hashes of the runs of ``n`` characters of a text column, in order."""
    count = F.length(c) - (n - 1)
    return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.xxhash64(F.lit(-n), F.substring(F.col(c), i + 1, F.lit(n))))).otherwise(F.array().cast("array<bigint>"))


def _chars_before(words: Column, n: Column) -> Column:
    """Characters before word ``n`` (from 0) of words that one space parts."""
    return F.length(F.array_join(F.slice(words, F.lit(1), n), " ")) + (n > 0).cast("int")


def find_quotes(quotes: DataFrame, docs: DataFrame, quote_id: str = "item_id", quote: str = "text",
                doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(quote_id, copies, doc_id, char_offset): which documents hold which quote first where, a row for each quote id.

    Equal quotes are collapsed for the search and get their ids back after it. Documents are normalised once and
    written; of their word shingles the positions of those that stand in some quote are kept. A quote's anchor is the
    shingle that the fewest positions have (with none, no document can hold it), so a quote of common words is looked
    up by its one rare place. A candidate carries the anchor's position in the document, and the quote is compared
    there and nowhere else. Inner words are used because a quote may begin or end inside a word; a quote of one or two
    words is looked up by runs of up to three characters the same way.
    """
    every = quotes.select(quote_id, X.normalize_for_match(quote).alias("_q"))
    q = every.where("_q <> ''").groupBy("_q").agg(F.count("*").alias("copies"))
    q = cut(q.select("_q", "copies", F.monotonically_increasing_id().alias("_n"), F.split("_q", " ").alias("_w")), "quotes")
    inner = F.least(F.size("_w") - 2, F.lit(SHINGLE))
    kind = F.when(inner > 0, inner).otherwise(-F.least(F.length("_q"), F.lit(3)))  # words above 0, characters below
    q = q.withColumn("_kind", kind)
    kinds = sorted(r[0] for r in q.select("_kind").distinct().collect())  # seven at most
    d = cut(docs.select(doc_id, X.normalize_for_match(text).alias("_t")).where("_t <> ''").withColumn("_d", F.monotonically_increasing_id()), "normalised")
    wanted, there = [], []
    for n in kinds:
        if n > 0:
            mine = q.select("_n", "_kind", F.slice("_w", F.lit(2), F.greatest(F.size("_w") - 2, F.lit(0))).alias("_in")).where(F.col("_kind") == n).select("_n", F.posexplode(_word_keys("_in", n)).alias("_at", "_key"))
            wanted.append(mine.withColumn("_at", F.col("_at") + 1))
            there.append(d.select("_d", F.split("_t", " ").alias("_w")).select("_d", F.posexplode(_word_keys("_w", n)).alias("_p", "_key")))
        else:
            wanted.append(q.where(F.col("_kind") == n).select("_n", F.posexplode(_char_keys("_q", -n)).alias("_at", "_key")))
            there.append(d.select("_d", F.posexplode(_char_keys("_t", -n)).alias("_p", "_key")))
    if not kinds:
        empty = T.StructType([quotes.schema[quote_id], T.StructField("copies", T.LongType()), docs.schema[doc_id], T.StructField("char_offset", T.LongType())])
        return docs.sparkSession.createDataFrame([], empty)
    wanted, there = reduce(DataFrame.unionByName, wanted), reduce(DataFrame.unionByName, there)
    # written first, so that its size is known: small, it is broadcast and no shingle of a document is shuffled
    keys = cut(wanted.select("_key").distinct(), "quote-keys")
    places = cut(there.join(keys, "_key", "left_semi"), "places")
    often = places.groupBy("_key").agg(F.count("*").alias("_often"))
    anchor = wanted.join(often, "_key", "left").groupBy("_n").agg(F.min(F.struct(F.coalesce("_often", F.lit(0)).alias("often"), "_key", "_at")).alias("_a"))
    anchor = anchor.where(F.col("_a")["often"] > 0).select("_n", F.col("_a")["_key"].alias("_key"), F.col("_a")["_at"].alias("_at"))
    words = F.split("_t", " ")
    start = F.when(F.col("_kind") > 0, _chars_before(words, F.col("_p")) - _chars_before(F.col("_w"), F.col("_at"))).otherwise(F.col("_p") - F.col("_at"))
    found = anchor.join(places, "_key").join(q, "_n").join(d, "_d").withColumn("_s", start)
    found = found.where((F.col("_s") >= 0) & (F.substring(F.col("_t"), F.col("_s") + 1, F.length("_q")) == F.col("_q")))
    found = found.groupBy("_n", "_d").agg(F.min("_s").cast("bigint").alias("char_offset")).join(d.select("_d", doc_id), "_d").join(q.select("_n", "_q", "copies"), "_n")
    return found.join(every, "_q").select(quote_id, "copies", doc_id, "char_offset")


def judge_facts(located: DataFrame, quote: str = "quote", value: str = "value") -> DataFrame:
    """Status ('kept'/'dropped') and reason of rows that carry ``char_offset``; row by row, so streams can be judged too."""
    groups = X.words(F.regexp_replace(value, r"[^\p{Nd}.]", " "))
    inside = X.let(X.normalize_for_match(quote), lambda q: F.forall(groups, lambda g: F.contains(q, g)))
    reason = F.when(F.col("char_offset").isNull(), "not located in canonical text").when(~inside, "value digits not inside the quote")
    return (located.withColumn("reason", reason)
            .withColumn("status", F.when(F.col("reason").isNull(), "kept").otherwise("dropped"))
            .withColumn("char_offset", F.when(F.col("reason").isNull(), F.col("char_offset"))))


def gate_facts(facts: DataFrame, docs: DataFrame, on: str = "doc_id", quote: str = "quote", value: str = "value",
               text: str = "text") -> DataFrame:
    """Facts plus status ('kept'/'dropped'), reason and char_offset."""
    return judge_facts(locate_verbatim(facts, docs, on, quote, text), quote, value)


def fact_yield(docs: DataFrame, gated: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: sentences mined, facts kept and dropped, and the failure if there is one."""
    mined = docs.select(id, F.size(X.numeric_sentence_array(text)).cast("bigint").alias("mined"))
    counts = gated.groupBy(id).agg(F.count_if(F.col("status") == "kept").alias("kept"),
                                   F.count_if(F.col("status") == "dropped").alias("dropped"))
    out = mined.join(counts, id, "left").fillna(0, ["kept", "dropped"])
    return out.withColumn("failure", F.when(F.col("mined") == 0, "no numeric sentences").when(F.col("kept") == 0, "no fact kept"))


def tiered_facts(articles: DataFrame, model: DataFrame, mined: DataFrame, qualitative: DataFrame, templates: DataFrame,
                 id: str = "article_id", least: int = 3) -> tuple[DataFrame, DataFrame]:
    """(facts, meta). Facts come from the first tier that brings at least ``least`` of them.

    Tiers: model facts; with mined facts whose claim the model did not give;
    with qualitative points; with the category's templates; else an error.
    """
    fresh = mined.join(model.select(id, "claim").distinct(), [id, "claim"], "left_anti")
    with_src = lambda df, n: df.withColumn("source", F.lit(n))
    # dealt out once: counting and the join below read the same rows where they lie, and mining is not done twice
    pool = dealt(with_src(model, 1).unionByName(with_src(fresh, 2)).unionByName(with_src(qualitative, 3), allowMissingColumns=True), id)
    n = lambda k: F.count_if(F.col("source") == k)
    counts = pool.groupBy(id).agg(n(1).alias("m"), n(2).alias("r"), n(3).alias("q"))
    per_cat = templates.groupBy("category").agg(F.count("*").alias("t"))
    meta = (articles.join(counts, id, "left").join(per_cat, "category", "left").fillna(0, ["m", "r", "q", "t"]))
    c = F.col("m") + F.col("r")
    tier = (F.when(F.col("m") >= least, 1).when(c >= least, F.when(F.col("m") > 0, 1).otherwise(2))
            .when(c + F.col("q") >= least, 3).when(F.col("t") > 0, 4))
    upto = F.when(F.col("m") >= least, 1).when(c >= least, 2).when(c + F.col("q") >= least, 3).when(F.col("t") > 0, 4)
    meta = meta.select(id, "category", tier.alias("tier_used"), upto.alias("_upto"),
                       F.when((F.col("m") < least) & (c >= least), c).otherwise(F.col("m")).alias("numeric_count"),
                       F.when((c < least) & upto.isNotNull(), F.col("q")).otherwise(0).alias("punch_points_count"),
                       (upto == 4).alias("_tpl"))
    facts = pool.join(meta.select(id, "_upto"), id).where(F.col("source") <= F.col("_upto")).drop("_upto")
    filled = meta.where("_tpl").select(id, "category").join(templates, "category").drop("category").withColumn("source", F.lit(4))
    facts = facts.unionByName(filled, allowMissingColumns=True)
    return facts, meta.select(id, "category", "tier_used", "numeric_count", "punch_points_count",
                              F.coalesce("_tpl", F.lit(False)).alias("fell_back"),
                              F.when(F.col("tier_used").isNull(), "no tier produced facts").alias("error"))


def rule_fact_rows(differentiators: DataFrame, cta_lines: DataFrame) -> DataFrame:
    """(id, text, kind): differentiators, then call-to-action lines as cta1, cta2, …

    ``cta_lines`` carries its 0-based ``ord``, so numbering needs no global sort.
    """
    return differentiators.select("id", "text", F.lit("differentiator").alias("kind")).unionByName(
        cta_lines.select(F.concat(F.lit("cta"), (F.col("ord") + 1).cast("string")).alias("id"), "text", F.lit("cta").alias("kind")))
