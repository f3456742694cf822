"""Benchmark decontamination: hashed windows of test items looked up along every document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from transferkit.llm.tables import sized, stored
from transferkit.llm.words import BETWEEN, places, text_of, words

WIDTH = 10
# Window hashes up to which the set is broadcast whole, 32 bytes each in a worker; a larger set is met by its cells first,
# as many numbers, and only what shares a cell is shuffled.
BROADCAST_HASHES = 1 << 21
BETWEEN_OR_WORDS = rf"{BETWEEN}|[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def item_windows(benchmark: DataFrame, item_col: str, text_col: str, width: int) -> DataFrame:
    """Each distinct window once: its hash, words, length, and the ids of the items that hold it."""
    b = benchmark.select(F.col(item_col).cast("string").alias("item"), words(text_of(text_col)).alias("w"))
    b = b.select("item", "w", F.least(F.size("w"), F.lit(width)).alias("k")).where("k > 0")
    b = b.select("item", "k", F.explode(F.transform(places(F.size("w"), F.col("k")), lambda i: F.slice("w", i + 1, F.col("k")))).alias("words"))
    b = b.groupBy("words", "k").agg(F.collect_set("item").alias("items"))
    return b.select(F.xxhash64("words").alias("hash"), "words", "k", "items")


def _starts(w: Column, k: int) -> Column:
    """Every window of ``k`` words: length, place and hash."""
    return F.transform(
        places(F.size(w), k),
        lambda i: F.struct(
            F.lit(k).alias("len"), i.alias("at"), F.xxhash64(F.slice(w, i + 1, F.lit(k))).alias("h")
        ),
    )


def _meeting(starts: DataFrame, hashes: DataFrame, n: int) -> DataFrame:
    """Markers, and the windows whose hash is in the set."""
    known = hashes.select(F.col("hash").alias("h"), F.lit(True).alias("known"))
    if n <= BROADCAST_HASHES:
        known = F.broadcast(known)
    else:
        cell = F.pmod("h", F.lit(BROADCAST_HASHES))
        cells = known.select(cell.alias("cell")).distinct().withColumn("near", F.lit(True))
        starts = starts.withColumn("cell", cell).join(F.broadcast(cells), "cell", "left").where("len = 0 or near").drop("cell", "near")
    return starts.join(known, "h", "left").where("len = 0 or known")


def _hits(
    docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str, width: int
) -> DataFrame:
    """Per distinct (id, text): its words, hit places and items, and how many input rows it stands for.

    A document's windows go out as hashes alone, so the work grows with its length; only a marker for each document and the
    windows met are shuffled.  The words of documents with such windows are then looked up and compared.
    """
    windows = stored(item_windows(benchmark, item_col, item_text_col, width), "benchmark_windows")
    hashes = windows.select("hash").distinct()
    lengths = sorted(r.k for r in windows.select("k").distinct().collect())  # at most ``width`` numbers
    texts = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    texts = texts.select("id", "text", F.xxhash64("text").alias("text_hash"))
    d = texts.select("id", "text_hash", words(F.col("text")).alias("w")).select("*", F.size("w").alias("n"))
    # a marker's own hash, so that markers are dealt out evenly
    marker = F.array(F.struct(F.lit(0).alias("len"), F.lit(0).alias("at"), F.xxhash64(F.lit(-1), "text_hash").alias("h")))
    # exploded where it is made: a filter on a column of its own would be pushed below the words and make them anew
    starts = F.explode(F.concat(marker, *[_starts(F.col("w"), k) for k in lengths]))
    d = d.select("id", "text_hash", "n", starts.alias("x")).select("id", "text_hash", "n", "x.*")
    met = _meeting(d, hashes, hashes.count()).groupBy("id", "text_hash").agg(
        F.max("n").alias("n"),
        F.sum((F.col("len") == 0).cast("int")).alias("rows"),
        F.collect_set(F.when(F.col("len") > 0, F.struct("at", "len", "h"))).alias("spans"),
    )
    met = stored(met, "met_windows")
    spans = met.where(F.size("spans") > 0).select("id", "text_hash", F.explode("spans").alias("s"))
    spans = spans.join(windows, (F.col("s.h") == F.col("hash")) & (F.col("s.len") == F.col("k")))
    claims = spans.groupBy("id", "text_hash").agg(F.collect_list(F.struct("s.at", "s.len", "words", "items")).alias("claims"))
    claims = sized(claims.withColumnsRenamed({"id": "claim_id", "text_hash": "claim_hash"}), "claimed_windows")
    same = F.col("id").eqNullSafe(F.col("claim_id")) & (F.col("text_hash") == F.col("claim_hash"))
    checked = texts.join(claims, same).select("claim_id", "claim_hash", words(F.col("text")).alias("w"), "claims")
    held = F.filter("claims", lambda c: F.slice("w", c["at"] + 1, c["len"]) == c["words"])
    checked = checked.select("claim_id", "claim_hash", held.alias("held"))
    at = F.flatten(F.transform("held", lambda c: F.sequence(c["at"], c["at"] + c["len"] - 1)))
    items = F.flatten(F.transform("held", lambda c: c["items"]))
    checked = checked.select("claim_id", "claim_hash", F.array_distinct(at).alias("hit"), F.array_distinct(items).alias("items"))
    # repeated rows were looked up as often as they stand, with one result
    checked = checked.groupBy("claim_id", "claim_hash").agg(F.first("hit").alias("hit"), F.first("items").alias("items"))
    out = met.drop("spans").join(checked, same, "left")
    none = F.expr("array()")
    return out.select(
        "id", "text_hash", "n", "rows",
        F.coalesce("hit", none.cast("array<int>")).alias("hit"), F.coalesce("items", none.cast("array<string>")).alias("items"),
    )


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    width: int = WIDTH,
) -> DataFrame:
    """Hit words and items of every document, one row for each input row.

    A null or empty text has no words and no hits; a repeated row gives a repeated result.  Items without
    words have no windows; an item without an id marks words but is not listed; items that share an id count
    once.  With an empty benchmark nothing is hit.  Other columns are not read.
    """
    d = _hits(docs, benchmark, id_col, text_col, item_col, item_text_col, width)
    return d.select(
        F.col("id").alias(id_col),
        F.col("n").cast("long").alias("n_words"),
        F.size("hit").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.sort_array("items")), 256).alias("items_sha256"),
        (F.size("hit") > 0).alias("contaminated"),
        F.explode(F.array_repeat(F.lit(0), F.col("rows").cast("int"))).alias("copy"),
    ).drop("copy")


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    remove: str = "documents",
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    width: int = WIDTH,
) -> DataFrame:
    """The input's rows and columns without contaminated documents, or without the hit words.

    With ``remove="spans"`` the words go and what stands between them stays; a text without hits is unchanged,
    a null one stays null.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove is 'documents' or 'spans', not {remove!r}")
    d = _hits(docs, benchmark, id_col, text_col, item_col, item_text_col, width)
    bad = sized(d.where(F.size("hit") > 0).select("id", "text_hash", "hit"), "contaminated")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(id_col).alias("row_id"),
        F.xxhash64(text_of(text_col)).alias("row_hash"),
    )
    on = F.col("row_id").eqNullSafe(F.col("id")) & (F.col("row_hash") == F.col("text_hash"))
    if remove == "documents":
        return rows.join(bad, on, "left_anti").select("row.*")
    text = F.col("row")[text_col]
    pieces = F.regexp_extract_all(text, F.lit(f"({BETWEEN_OR_WORDS})"), F.lit(1))
    # words and what stands between them alternate
    first = F.when(text.rlike(f"^{BETWEEN}"), 1).otherwise(0)
    kept = F.filter(
        pieces,
        lambda p, i: ((i - F.col("first")) % 2 != 0)
        | ~F.array_contains("hit", F.floor((i - F.col("first")) / 2).cast("int")),
    )
    rows = rows.join(bad, on, "left").select("row", "hit", first.alias("first"))
    cleaned = F.when(F.col("hit").isNull(), text).otherwise(F.array_join(kept, ""))
    return rows.select(*[(cleaned if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns])
