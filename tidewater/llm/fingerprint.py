"""Document fingerprints by a threshold-scaled sketch (native).

Every five-word shingle is hashed to 64 bits; the sketch keeps each hash below
a fixed fraction of the hash range, whatever the length of the document.  So
two sketches of very unequal documents are comparable, the sketch of a union is
the union of the sketches, and |A & B| / |A| estimates how much of A is
contained in B.  The smallest hash is kept as well, so that a short text never
has an empty sketch; texts under five words have one shingle of all their
words, and a text without words has the empty sketch.

The query pairs each document with the next one in ascending doc_id without a
global sort: ids are cut into blocks of 2^12 consecutive values, a window
inside each block finds the next row, and only the first document of each
block goes through a second, smaller level.

Defined results: a null text is empty; a document's successor is the next
*larger* doc_id (of repeated ids, its smallest text), after the last the first;
rows with a null id count as standing before the first; repeated rows each get
a row; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewater.llm.base import let, pick, register, table, words

SHINGLE = 5
FRACTION = 1 / 4
BLOCK_BITS = 12
#: The block of rows without an id; no id's block is as small.
NO_ID = -(1 << 63)


def shingle_hashes(text: Column, k: int = SHINGLE) -> Column:
    """The 64-bit hash of every run of ``k`` words (of all words, if fewer)."""
    def of(w: Column) -> Column:
        n = F.size(w)
        return (F.when(n == 0, F.array().cast("array<bigint>"))
                .when(n < k, F.array(F.xxhash64(w)))
                .otherwise(F.transform(F.sequence(F.lit(1), F.greatest(n - (k - 1), F.lit(1))),
                                       lambda i: F.xxhash64(F.slice(w, i, k)))))

    return let(words(text), of)


def sketch(hashes: Column, fraction: float = FRACTION) -> Column:
    """The hashes below ``fraction`` of the signed 64-bit range, and the smallest; sorted, distinct."""
    below = F.lit(int(-(1 << 63) + fraction * (1 << 64)))

    def of(h: Column) -> Column:
        return let(F.filter(h, lambda x: x < below), lambda low: F.when(F.size(low) > 0, low).when(
            F.size(h) > 0, F.array(F.array_min(h))).otherwise(h))

    return F.array_sort(F.array_distinct(let(hashes, of)))


def merge(a: Column, b: Column, fraction: float = FRACTION) -> Column:
    """The sketch of both documents together."""
    return sketch(F.array_union(a, b), fraction)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b has; two empty sketches are alike."""
    both = F.size(F.array_intersect(a, b)) / F.greatest(F.size(a), F.lit(1))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(both.cast("double"))


def as_string(s: Column) -> Column:
    return F.array_join(F.transform(s, lambda h: F.lower(F.hex(h))), ",")


def with_next(docs: DataFrame, bits: int = BLOCK_BITS) -> DataFrame:
    """doc_id, text, next_text for rows (doc_id, text)."""
    rows = docs.withColumn("block", F.coalesce(F.shiftright("doc_id", bits), F.lit(NO_ID)))
    down = Window.partitionBy("block").orderBy(F.col("doc_id").desc(), F.col("text").desc())
    so_far = down.rowsBetween(Window.unboundedPreceding, 0)
    prior = F.when(F.lag("doc_id").over(down) > F.col("doc_id"), F.lag("text").over(down))
    inside = rows.withColumn("prior", prior).withColumn("prior", F.last("prior", ignorenulls=True).over(so_far))
    # the window's partitioning serves the join, so the texts move once
    return (inside.join(_first_of_next_block(rows, bits), "block", "left")
            .select("doc_id", "text", F.coalesce("prior", "first_text").alias("next_text")))


def _first_of_next_block(rows: DataFrame, bits: int) -> DataFrame:
    """(block, first_text): for each block the text that follows its largest
    id; rows without id are followed by the first document."""
    firsts = (rows.where("doc_id is not null").groupBy("block")
              .agg(F.min(F.struct("doc_id", "text")).alias("first")))
    up = firsts.withColumn("group", F.shiftright("block", bits))
    chained = up.withColumn("next", F.lead("first").over(Window.partitionBy("group").orderBy("block")))
    # one row per group of 2^(2 * bits) ids: the last step's single window
    groups = firsts.groupBy(F.shiftright("block", bits).alias("group")).agg(F.min("first").alias("head"))
    wrap = Window.orderBy("group")
    groups = groups.select("group", F.coalesce(F.lead("head").over(wrap), F.first("head").over(wrap)).alias("after"),
                           F.first("head").over(wrap).alias("first_doc"))
    out = chained.join(groups, "group").select("block", F.coalesce("next", "after")["text"].alias("first_text"))
    nulls = groups.where("group is not null").agg(F.min("first_doc")["text"].alias("first_text"))
    return out.unionByName(nulls.select(F.lit(NO_ID).alias("block"), "first_text"))


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          fraction: float = FRACTION) -> DataFrame:
    """doc_id and the sketch (sorted array of hashes) of every row."""
    src = pick(docs, doc_id=id_col, text=text_col)
    return src.select("doc_id", sketch(shingle_hashes(F.col("text")), fraction).alias("sketch"))


@register("op8_fingerprint")
def op8_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n = F.length("text")
    q = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring("text", 1, n - q), F.substring("next_text", 1, q))
    rows = with_next(docs).withColumn("edited", edited)
    of = lambda c: sketch(shingle_hashes(F.col(c)))
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                       of("text").alias("a"), of("edited").alias("b"), of("next_text").alias("c"))
    return rows.select("doc_id", "n_chars", "edited_sha256", as_string(F.col("a")).alias("fingerprint"),
                       as_string(F.col("b")).alias("edited_fingerprint"),
                       containment(F.col("a"), F.col("b")).alias("near_edited"),
                       containment(F.col("a"), F.col("c")).alias("near_next"))
