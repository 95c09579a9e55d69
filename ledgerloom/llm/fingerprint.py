"""Document fingerprints: bottom-k sketches of shingle hashes, as DataFrame functions only.

A sketch is the sorted array of the k least distinct hashes of a text's shingles. The sketch of several
parts is the k least of their sketches together. Shingles are runs of five words; a text of fewer words has
its whole sequence as its one shingle, a text without words has none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.tables import Scratch

K = 128
WORDS = 5
_SPACE = r"[\x20\x09-\x0D]+"
_RANGE = float(2**64)


def words(text: Column) -> Column:
    return F.filter(F.split(text, _SPACE), lambda w: w != "")


def sketch(words: Column, k: int = K, n: int = WORDS) -> Column:
    """Sketch of an array of words.

    ``words`` should be a column, not an expression, since each shingle refers to it.
    """
    hashes = F.transform(F.sequence(F.lit(1), F.greatest(F.size(words) - (n - 1), F.lit(1))), lambda i: F.xxhash64(F.slice(words, i, n)))
    return F.when(F.size(words) > 0, F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)).otherwise(F.array().cast("array<bigint>"))


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two parts together."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def _least_of_both(a: Column, b: Column, k: int) -> Column:
    # Below k hashes a sketch is the whole set, and of two whole sets all hashes count.
    whole = (F.size(a) < k) & (F.size(b) < k)
    union = F.sort_array(F.array_union(a, b))
    return F.slice(union, 1, F.when(whole, F.greatest(F.size(union), F.lit(1))).otherwise(F.lit(k)))


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimate of the shingles in both by those in either, 0 to 1; exact for sketches under k; 1 if neither has any."""
    least = _least_of_both(a, b, k)
    common = F.size(F.array_intersect(F.array_intersect(least, a), b))
    return F.when(F.size(least) == 0, F.lit(1.0)).otherwise(common / F.size(least))


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimate of the number of distinct shingles; exact under k. It takes the k-th hash's place in their range."""
    place = (F.element_at(a, -1).cast("double") + F.lit(2.0**63)) / F.lit(_RANGE)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / place)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimate of the share of a's shingles that b has too: resemblance times the size of both together, by a's."""
    either = distinct_shingles(merge(a, b, k), k)
    whole = (F.size(a) < k) & (F.size(b) < k)
    exact = F.size(F.array_intersect(a, b)) / F.size(a)
    estimate = F.least(F.lit(1.0), resemblance(a, b, k) * either / distinct_shingles(a, k))
    return F.when(F.size(a) == 0, F.lit(1.0)).when(whole, exact).otherwise(estimate)


def as_text(a: Column) -> Column:
    """The sketch's hashes as 16 hexadecimal digits each."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.hex(h), 16, "0")), "")


def with_sketch(df: DataFrame, text: str, to: str) -> DataFrame:
    """``df`` with the sketch ``to`` of column ``text``; null counts as empty."""
    held = f"{to}_words"
    return df.withColumn(held, words(F.coalesce(F.col(text), F.lit("")))).withColumn(to, sketch(F.col(held))).drop(held)


def next_ids(ids: DataFrame, scratch: Scratch) -> DataFrame:
    """``id, next_id`` of distinct ids: the next greater one, after the last the first.

    Ids are dealt by range, so that each part needs of the others only where the next one begins.
    """
    dealt = scratch.write(ids.distinct().repartitionByRange("id").withColumn("part", F.spark_partition_id()))
    starts = dealt.groupBy("part").agg(F.min("id").alias("first"))
    whole = Window.partitionBy()  # one row for each part
    following = starts.select("part", F.coalesce(F.lead("first").over(whole.orderBy("part")), F.min("first").over(whole)).alias("after"))
    within = Window.partitionBy("part").orderBy("id")
    return dealt.join(following, "part").select("id", F.coalesce(F.lead("id").over(within), "after").alias("next_id"))


def with_edited(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, text, edited, sketch, edited_sketch, next_sketch`` of every row.

    ``edited`` is the text with its last floor(n / 4) code points replaced by the first as many, or all, of
    the document with the next greater id, after the last the first. A null text is empty. Of several rows
    with one id each keeps its own text, and as a next document the least text counts. Rows with a null id
    have no place in the order: their own sketch is all they have, the rest is null. An empty table gives an empty result.
    """
    scratch = Scratch(df.sparkSession, "fingerprint")
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    docs = rows.where("id is not null")
    quarter = F.floor(F.char_length("text") / 4).cast("int")
    order = next_ids(docs.select("id"), scratch)
    needs = docs.select("id", quarter.alias("need")).groupBy("id").agg(F.max("need").alias("need")).join(order, "id")
    needs = needs.select(F.col("id").alias("of"), "next_id", "need")
    # Both joins deal the texts by id: one exchange serves them. Sketches are made behind it.
    heads = with_sketch(docs.join(needs, F.col("id") == F.col("next_id")), "text", "next_sketch")
    heads = heads.select("of", F.struct(F.substring("text", F.lit(1), F.col("need")).alias("head"), "next_sketch").alias("next"))
    heads = heads.groupBy("of").agg(F.min("next").alias("next"))
    edited = F.concat(F.substring("text", F.lit(1), F.char_length("text") - quarter), F.substring("next.head", F.lit(1), quarter))
    joined = docs.join(heads, F.col("id") == F.col("of")).select("id", "text", edited.alias("edited"), F.col("next.next_sketch").alias("next_sketch"))
    placed = with_sketch(with_sketch(joined, "text", "sketch"), "edited", "edited_sketch")
    alone = with_sketch(rows.where("id is null"), "text", "sketch").select("id", "text", F.lit(None).cast("string").alias("edited"), "sketch")
    return placed.unionByName(alone, allowMissingColumns=True).withColumnRenamed("id", id_col)
