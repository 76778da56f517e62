"""Benchmark decontamination: short test items found inside long documents.

Items are partitioned by size (number of distinct five-word shingles, in powers of two). Each item is sketched by its
least MinHash values; the sketch length of a partition is the number of shingles its largest item may miss, plus one. A
document that contains the wanted share of an item therefore holds at least one value of its sketch, so the search over
sketches loses nothing, and the share of the sketch that a document holds estimates the containment. Candidates are
then verified by exact containment: shared distinct shingles over the item's distinct shingles.

Words are runs without ASCII white space, in lower case. An item with one to four words is one shingle of that many
words; an item without words, or with null text, is contained in nothing. Null document text is empty. Repeated rows
(same doc_id and text) give one row an item; repeated items are separate rows. A null doc_id is kept as null.
Documents are never shuffled as texts for the search; the item tables are broadcast only below `broadcast_rows` rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sundial.llm.shared import bounded, fresh, saved

WORDS = 5
BROADCAST_ROWS = 500_000


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def _shingles(words: Column, width: Column | int) -> Column:
    """Distinct hashes of all runs of `width` words."""
    last = F.size(words) - width
    at = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(at, lambda i: _hash(words, i, width)))


def _hash(words: Column, at: Column, width: Column | int) -> Column:
    if isinstance(width, int):
        return F.xxhash64(*[F.get(words, at + i) for i in range(width)])
    # shorter items: absent words are null and leave the hash as it is
    return F.xxhash64(*[F.when(F.lit(i) < width, F.get(words, at + i)) for i in range(WORDS)])


def item_shingles(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item, width, n_item (distinct shingles) and shingle: one row per distinct shingle."""
    own = benchmark.select(F.col(item_id).alias("item"), _words(F.col(text)).alias("words")).where("size(words) > 0")
    own = own.select("item", F.monotonically_increasing_id().alias("row"), F.least(F.size("words"), F.lit(WORDS)).alias("width"), "words")
    cut = own.select("item", "row", "width", _shingles(F.col("words"), F.col("width")).alias("shingles"))
    return cut.select("item", "row", "width", F.size("shingles").alias("n_item"), F.explode("shingles").alias("shingle"))


def sketches(items: DataFrame, share: float) -> DataFrame:
    """The least MinHash values of each item, as many as its size partition needs.

    `items` needs the columns of `item_shingles`; the order is that of a second hash of the shingle, ties by shingle.
    """
    band = F.floor(F.log2("n_item"))
    largest = F.pow(F.lit(2), band + 1) - 1
    length = (largest - F.ceil(largest * share) + 1).cast("int")
    ordered = items.groupBy("item", "row", "width", "n_item").agg(F.array_sort(F.collect_list(F.struct(F.xxhash64("shingle", F.lit(17)).alias("place"), "shingle"))).alias("all"))
    return (ordered.withColumn("length", F.least(F.col("n_item"), length))
            .select("item", "row", "width", "n_item", "length", F.explode(F.slice("all", F.lit(1), F.col("length"))).alias("s"))
            .select("item", "row", "width", "n_item", "length", F.col("s.shingle").alias("shingle")))


def _bounded(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def contained(documents: DataFrame, benchmark: DataFrame, share: float = 0.75, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text_key, item_id, n_item, n_shared, containment, estimate: items of which a document holds the share or more."""
    items = saved(item_shingles(benchmark), "items")
    sizes = items.groupBy("width").agg(F.count("*").alias("n")).collect()  # five rows at most
    spark = documents.sparkSession
    if not sizes:
        return spark.createDataFrame([], OUTPUT)
    rows = sum(r.n for r in sizes)
    widths = sorted(r.width for r in sizes)
    short = sketches(items, share)
    own = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    own = own.select("doc_id", F.xxhash64("text", F.length("text")).alias("text_key"), _words(F.col("text")).alias("words"))

    def exploded(df: DataFrame) -> DataFrame:
        """One row per distinct shingle of every width that some item has."""
        streams = [df.select("doc_id", "text_key", F.lit(w).alias("width"), F.explode(_shingles(F.col("words"), w)).alias("shingle")) for w in widths]
        out = streams[0]
        for s in streams[1:]:
            out = out.unionByName(s)
        return out

    candidates = saved(exploded(own).join(_bounded(short, rows), ["width", "shingle"])
                       .groupBy("doc_id", "text_key", "item", "row").agg(F.count_distinct("shingle").alias("hits"), F.first("length").alias("length")), "candidates")
    chosen = own.join(candidates.select("text_key").distinct(), "text_key", "left_semi")
    shared = (exploded(chosen).join(_bounded(items, rows), ["width", "shingle"])
              .groupBy("doc_id", "text_key", "item", "row").agg(F.count_distinct("shingle").alias("n_shared"), F.first("n_item").alias("n_item"))
              .where(F.col("n_shared") >= F.col("n_item") * F.lit(share)))
    same = [candidates.doc_id.eqNullSafe(shared.doc_id), candidates.text_key == shared.text_key, candidates.row == shared.row]
    return (candidates.join(shared, same).select(
        candidates.doc_id, candidates.text_key, candidates.item.alias("item_id"), shared.n_item.cast("long").alias("n_item"), shared.n_shared,
        (shared.n_shared / shared.n_item).alias("containment"), (candidates.hits / candidates.length).alias("estimate")))


OUTPUT = "doc_id long, text_key long, item_id long, n_item long, n_shared long, containment double, estimate double"


def clean(documents: DataFrame, benchmark: DataFrame, share: float = 0.75) -> DataFrame:
    """Documents, all columns whatever their names, without those that contain an item."""
    key, = fresh(["__key"], documents.columns)
    found = contained(documents, benchmark, share).select(F.col("text_key").alias(key)).distinct()
    found = bounded(saved(found, "contaminated"))
    return (documents.withColumn(key, F.xxhash64("text", F.length("text"))).join(found, key, "left_anti").select(*[f"`{c}`" for c in documents.columns]))
