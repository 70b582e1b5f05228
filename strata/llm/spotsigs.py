"""SpotSigs document fingerprints, in DataFrame operations only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strata.llm.common import Scratch, quoted

# Common words of four languages after which chains begin.
COMMON_WORDS = (
    "a an the and are as at be by for from has have he in is it of on or that this to was were which with "
    "au aux de des du elle en est et la le les pour que qui sur un une dans par "
    "das dem den der die ein eine für im ist mit nicht sich und von zu auf "
    "al con del el es los las para se su una por no lo"
).split()
CHAIN = 2  # content words of a chain
SPARE = 8  # one content word in so many begins a chain of its own
BUCKET_ROWS = 200_000
# Whatever is no part of a word.
_MARKS = r"[^\p{L}\p{M}\p{N}\s]+"


def signatures(text: Column, common: tuple[str, ...] = tuple(COMMON_WORDS), chain: int = CHAIN) -> Column:
    """Sorted distinct hashes of the spot signatures of a text, null as empty.

    Words are what blanks separate, lower-cased and without punctuation (of a
    text of nothing else, as they are). The signature of a common word is the
    word with the ``chain`` content words that follow it, other common words
    skipped; at the end of the text fewer, with none there is no signature. So
    that texts with few common words, or none, have signatures of the same kind
    as any other text, the first content word and every one whose hash is divisible
    by ``SPARE`` begin such a chain too. A text of common words alone is
    represented by them in order; one without words by the empty set."""
    low = F.lower(F.coalesce(text, F.lit("")))
    bare = _bound(F.struct(low.alias("low"), F.regexp_replace(low, _MARKS, "").alias("bare")), lambda x: F.when(x["bare"].rlike(r"\S"), x["bare"]).otherwise(x["low"]))
    words = F.filter(F.split(bare, r"\s+"), lambda w: w != "")

    def parts(words: Column) -> Column:
        anchors = F.filter(F.transform(words, lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda x: x["w"].isin(*common))
        return F.struct(words.alias("words"), anchors.alias("anchors"), F.filter(words, lambda w: ~w.isin(*common)).alias("content"))

    def found(x: Column) -> Column:
        content = x["content"]
        # Before the k-th common word, at place i, stand i - k content words.
        spots = F.filter(F.transform(x["anchors"], lambda a, k: F.struct(a["w"].alias("w"), (a["i"] - k).alias("at"))), lambda s: s["at"] < F.size(content))
        spare = F.filter(F.transform(content, lambda w, c: F.struct(w.alias("w"), (c + 1).alias("at"))), lambda s: (s["at"] == 1) | (F.xxhash64(s["w"]) % SPARE == 0))
        chains = F.transform(F.concat(spots, spare), lambda s: F.xxhash64(s["w"], *[F.get(content, s["at"] + j) for j in range(chain)]))
        return F.when((F.size(content) == 0) & (F.size(x["words"]) > 0), F.array(F.xxhash64(F.array_join(x["words"], " ")))).otherwise(chains)

    return F.sort_array(F.array_distinct(_bound(_bound(words, parts), found)))


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often ``use`` reads it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def fingerprint(sigs: Column) -> Column:
    """The set as text: 16 hex digits per signature, ascending."""
    return F.array_join(F.transform(sigs, lambda s: F.lpad(F.lower(F.hex(s)), 16, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two sets; 1 for two empty sets. Sets whose sizes
    alone exclude any common element (one empty) are not intersected."""
    common = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - common
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).when((F.size(a) == 0) | (F.size(b) == 0), 0.0).otherwise(common / union)


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """``doc_id, text, sigs, next_text, next_sigs`` per row: text and signatures of
    the document and of that with the next larger id; after the last one comes the
    first. Null texts are empty, a null id sorts first, rows with one id are ordered
    by a hash of the text. A text's signatures are made once, before it is sent.

    The ids are cut at approximate quantiles into buckets (about ``bucket_rows``
    rows, and eight for each shuffle partition at least); the first id of every
    bucket is also sent to the bucket before, so one window per bucket sees all
    successors and texts are shuffled once. Of the table, the driver sees the
    cuts and the first id of each bucket."""
    spark = docs.sparkSession
    rows = docs.select(quoted(id_col).alias("doc_id"), F.coalesce(quoted(text_col), F.lit("")).alias("text"))
    n = rows.count()
    wanted = max(8 * int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n / bucket_rows))
    shares = [k / wanted for k in range(1, wanted)]
    cuts = rows.agg(F.percentile_approx("doc_id", shares, max(10_000, 2 * wanted))).first()[0] or []
    cuts = sorted(set(cuts))
    kind = docs.schema[id_col].dataType
    bucket = F.coalesce(_rank(F.col("doc_id"), cuts, kind), F.lit(0))
    firsts = {r[0]: r[1] for r in rows.groupBy(bucket.alias("b")).agg(F.min(F.struct("doc_id")).getField("doc_id")).collect()}
    order = sorted(firsts)
    before = {b: order[i - 1] for i, b in enumerate(order)}
    count = len(cuts) + 1
    first_id = F.element_at(F.array(*[F.lit(firsts.get(b)).cast(kind) for b in range(count)]), F.col("b") + 1)
    previous = F.element_at(F.array(*[F.lit(before.get(b)).cast("int") for b in range(count)]), F.col("b") + 1)
    own = F.struct(F.col("b"), F.lit(False).alias("guest"))
    guest = F.struct(previous.alias("b"), F.lit(True).alias("guest"))
    sent = F.when(F.col("doc_id").eqNullSafe(first_id), F.array(own, guest)).otherwise(F.array(own))
    dealt = rows.withColumn("sigs", signatures(F.col("text"))).withColumn("b", bucket).select("doc_id", "text", "sigs", F.inline(sent).alias("b", "guest"))
    after = W.partitionBy("b").orderBy("guest", F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))
    following = [F.lead(c).over(after).alias(f"next_{c}") for c in ("text", "sigs")]
    return dealt.select("*", *following).where("not guest").select("doc_id", "text", "sigs", "next_text", "next_sigs")


def _rank(x: Column, cuts: list, kind) -> Column:
    """Number of cuts that are at most ``x``, by bisection."""
    if not cuts:
        return F.lit(0)
    table = F.array(*[F.lit(c).cast(kind) for c in cuts])
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(cuts).bit_length()))])
    return F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: F.when((at + step <= len(cuts)) & (F.get(table, at + step - 1) <= x), at + step).otherwise(at),
    )


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document's signatures beside those of its edited text (the last
    quarter of its code points, rounded down, replaced by as many from the start
    of the next document) and of the next document: ``doc_id, n_chars, edited,
    sigs, edited_sigs, near_edited, near_next``."""
    n = F.char_length("text")
    cut = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - cut), F.substring(F.col("next_text"), F.lit(1), cut))
    texts = with_next(docs, id_col, text_col).select("doc_id", n.cast("long").alias("n_chars"), edited.alias("edited"), "sigs", "next_sigs")
    sets = texts.withColumn("edited_sigs", signatures(F.col("edited")))
    near = [likeness(F.col("sigs"), F.col(x)).alias(y) for x, y in (("edited_sigs", "near_edited"), ("next_sigs", "near_next"))]
    return sets.select("doc_id", "n_chars", "edited", "sigs", "edited_sigs", *near)


def near_pairs(sets: DataFrame, scratch: Scratch, threshold: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """SpotSigs matching of ``sets`` (doc_id, sigs): ``members`` (doc_id,
    set_id), the documents with one and the same set; and ``pairs`` (a, b,
    likeness), a < b, of all different non-empty sets with a Jaccard similarity of at least
    ``threshold``; set_id is the smallest doc_id of a set.

    Sets are partitioned by length, each range 1/threshold times as long as the
    one before: similar sets lie in one range or in neighbouring ones. Within
    these only sets that share one of their rarest signatures can be similar
    (of n signatures, the n - ceil(threshold n) + 1 rarest); such a pair is
    compared once, for the first signature they share, if its lengths allow
    the similarity."""
    print_ = fingerprint(F.col("sigs"))
    classed = scratch.put(sets.select("doc_id", "sigs", F.sha2(print_, 256).alias("h")), "sets")
    classes = scratch.put(classed.groupBy("h").agg(F.min("doc_id").alias("set_id"), F.first("sigs").alias("sigs")).where("size(sigs) > 0"), "classes")
    members = classed.join(classes.select("h", "set_id"), "h").select("doc_id", "set_id")
    counts = scratch.put(classes.select(F.explode("sigs").alias("s")).groupBy("s").agg(F.count("*").alias("n")).where("n > 1"), "counts")
    rare = (
        classes.select("set_id", F.size("sigs").alias("size"), F.explode("sigs").alias("s"))
        .join(counts, "s", "left")
        .groupBy("set_id", "size")
        .agg(F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(1)).alias("n"), "s"))).alias("ranked"))
    )
    head = F.slice("ranked", F.lit(1), F.col("size") - F.ceil(F.col("size") * threshold - 1e-9).cast("int") + 1)
    length = F.floor(F.log(F.col("size").cast("double")) / math.log(1 / threshold) + 1e-9).cast("int")
    rare = scratch.put(rare.select("set_id", "size", length.alias("range"), F.filter(head, lambda x: x["n"] > 1).alias("head")), "rare")
    index = rare.select("set_id", "size", "range", "head", F.explode("head.s").alias("s"))
    probe = index.select(F.col("set_id").alias("a"), F.col("size").alias("size_a"), F.col("head").alias("head_a"), "s", F.explode(F.array("range", F.col("range") + 1)).alias("range"))
    index = index.select(F.col("set_id").alias("b"), F.col("size").alias("size_b"), F.col("head").alias("head_b"), "s", "range", F.col("range").alias("own"))
    found = probe.join(index, ["s", "range"]).where(
        "(size_a < size_b or size_a = size_b and a < b) and a <> b"
    ).where(F.col("size_a") >= F.col("size_b") * threshold - 1e-9).where(
        F.element_at(F.array_intersect("head_a.s", "head_b.s"), 1) == F.col("s")
    ).select("a", "b")
    sigs = classes.select("set_id", "sigs")
    both = found.join(sigs.withColumnsRenamed({"set_id": "a", "sigs": "sa"}), "a").join(sigs.withColumnsRenamed({"set_id": "b", "sigs": "sb"}), "b")
    pairs = both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), likeness(F.col("sa"), F.col("sb")).alias("likeness"))
    return members, pairs.where(F.col("likeness") >= threshold - 1e-12)
