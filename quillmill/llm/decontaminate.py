r"""Benchmark decontamination through a distributed positional inverted index [native].

* Index: every word of every document is a posting (term id, term, document key,
  position); the term id is a 64-bit hash of the term. Each scan task writes one segment,
  sorted by term id, so that row-group statistics give posting lists without reading
  the rest. The posting list of the blank term holds the documents: their ids, and their
  lengths in words. An index is a folder: any number of benchmarks can be searched in it.
* Rarest terms: the document frequency of a benchmark term is the length of its list. Of
  each window, the two rarest terms that occur at all are looked up, and the second
  one's list is intersected with the first one's, both shifted by their offsets in the
  window, with a tolerance of SLOP positions.
* Exact phrases: where the shifted lists meet at the same offset there may be an
  occurrence (document, item, offset). Only there the lists of the item's other terms
  are intersected, by the terms themselves: what stands at its place is a matched
  position, and every run of matched positions as long as a window consists of occurrences.
* Proximity: where the shifted lists meet within SLOP positions, inserted or lost words
  included, document and item are a proximity match. Beside it, the largest share of an
  item's words that stand at their places along one offset is returned.

Words: A-Z are lowered, then maximal runs of [^\x00-\x2F\x3A-\x60\x7B-\x7F].

Defined cases: null and wordless texts have no words and no hits; rows that share id
and text get the same result, rows that share only the id are told apart by a 64-bit
hash of id and text; items of fewer words than a window are one window; null, empty and
wordless items match nothing; repeated items count once by their id; a text may be of
any length; empty tables give empty or unhit results; other columns are ignored. Item
ids are sorted as strings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quillmill.session import cut_lineage, delete_path, maybe_broadcast, new_shared_path

#: What separates words before A-Z are lowered: ASCII without digits and letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A string that is no word; its list holds the documents.
_DOCUMENT = " "
#: Positions by which the two rarest terms of a proximity match may be off.
SLOP = 5


def ascii_lower(text: Column) -> Column:
    """Lower A-Z only. lower() does that for pure ASCII and is much faster."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(
        F.translate(text, _UPPER, _UPPER.lower())
    )


def document_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """What postings know a document by."""
    return F.xxhash64(F.col(id_col), F.col(text_col))


def _item_words(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(F.coalesce(text, F.lit(""))), SEPARATORS, -1), lambda w: w != "")


class PositionalIndex:
    """The index below one folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    @classmethod
    def build(cls, docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> PositionalIndex:
        """Write a segment for each scan task below path."""
        raw = F.split(F.coalesce(F.col(text_col), F.lit("")), SEPARATORS, -1)  # an empty string where separators begin or end the text
        words = docs.select(F.col(id_col).alias("doc"), document_key(id_col, text_col).alias("dk"), raw.alias("raw")).withColumn(
            "lead", (F.element_at("raw", 1) == "").cast("int")
        )
        length = F.size("raw") - F.col("lead") - ((F.size("raw") > 1) & (F.element_at("raw", -1) == "")).cast("int")
        is_document = F.col("word") == _DOCUMENT
        postings = (
            words.withColumn("length", length)
            .select("doc", "dk", "lead", "length", F.posexplode(F.concat("raw", F.array(F.lit(_DOCUMENT)))).alias("at", "word"))
            .filter("word <> ''")
            .withColumn("term", ascii_lower(F.col("word")))
            .select(
                F.xxhash64("term").alias("term_id"),
                "term",
                "dk",
                F.when(is_document, F.col("length")).otherwise(F.col("at") - F.col("lead")).alias("pos"),
                F.when(is_document, F.col("doc")).alias("doc"),
            )
        )
        postings.sortWithinPartitions("term_id").write.parquet(path)
        return cls(docs.sparkSession, path)

    def postings(self) -> DataFrame:
        """term_id, term, dk, pos of all words."""
        return self.spark.read.parquet(self.path).filter(F.col("term_id") != F.xxhash64(F.lit(_DOCUMENT))).select("term_id", "term", "dk", "pos")

    def documents(self) -> DataFrame:
        """doc, dk, n_words: a row for each row that was indexed."""
        listed = self.spark.read.parquet(self.path).filter((F.col("term_id") == F.xxhash64(F.lit(_DOCUMENT))) & (F.col("term") == _DOCUMENT))
        return listed.select("doc", "dk", F.col("pos").cast("long").alias("n_words"))

    def search(self, benchmark: DataFrame, window: int = 10, item_col: str = "item_id", item_text_col: str = "text", slop: int = SLOP) -> DataFrame:
        """dk, n_hit, items, near_items (sorted ids as strings), best_match: a row for each document with a match.

        items holds a whole window's words; near_items those that are near only or both.
        """
        named = benchmark.select(
            F.xxhash64(item_col, item_text_col).alias("ik"), F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
            _item_words(F.col(item_text_col)).alias("words"),
        ).filter(F.size("words") > 0)
        items = cut_lineage(named.dropDuplicates(["ik"]))
        flat = cut_lineage(items.select("ik", F.posexplode("words").alias("p", "term")).withColumn("term_id", F.xxhash64("term")))
        terms = maybe_broadcast(cut_lineage(flat.select("term_id").distinct()))
        postings = self.postings().join(terms, "term_id", "left_semi")
        frequency = cut_lineage(postings.groupBy("term_id").agg(F.count(F.lit(1)).alias("df")))
        probes = cut_lineage(_rarest_two(flat, frequency, window))
        met = cut_lineage(_meetings(self.postings(), probes, slop))

        # the lists of all terms of an item, at the offsets where its rarest ones met
        exact = cut_lineage(met.filter("gap = 0").select("dk", "ik", "delta"))
        wanted = exact.join(maybe_broadcast(flat), "ik").select("dk", "ik", "delta", "p", "term", (F.col("delta") + F.col("p")).alias("pos"))
        there = self.postings().join(maybe_broadcast(exact.select("dk").distinct()), "dk", "left_semi").join(terms, "term_id", "left_semi")
        matched = wanted.join(there, ["dk", "term", "pos"], "left_semi").select("dk", "ik", "delta", "p")

        line = Window.partitionBy("dk", "ik", "delta")
        runs = matched.withColumn("run", F.col("p") - F.row_number().over(line.orderBy("p"))).withColumn("matches", F.count(F.lit(1)).over(line))
        sizes = maybe_broadcast(items.select("ik", "item", F.size("words").alias("size")))
        judged = cut_lineage(
            runs.withColumn("run_size", F.count(F.lit(1)).over(Window.partitionBy("dk", "ik", "delta", "run")))
            .join(sizes, "ik")
            .select("dk", "item", (F.col("delta") + F.col("p")).alias("pos"), (F.col("run_size") >= F.least(F.lit(window), "size")).alias("hit"), (F.col("matches") / F.col("size")).alias("match"))
        )
        hit = judged.filter("hit")
        n_hit = hit.select("dk", "pos").distinct().groupBy("dk").agg(F.count(F.lit(1)).alias("n_hit"))
        near = met.select("dk", "ik").distinct().join(sizes, "ik").select("dk", "item")
        return (
            _listed(near, "near_items")
            .join(judged.groupBy("dk").agg(F.max("match").alias("best_match")), "dk", "left")
            .join(n_hit, "dk", "left")
            .join(_listed(hit.select("dk", "item"), "items"), "dk", "left")
        )


def _listed(rows: DataFrame, name: str) -> DataFrame:
    """dk, sorted distinct items: as many as the benchmark has at most."""
    return rows.distinct().groupBy("dk").agg(F.array_sort(F.collect_list("item")).alias(name))


def _rarest_two(flat: DataFrame, frequency: DataFrame, window: int) -> DataFrame:
    """ik, t1, p1, t2, p2: of each window the two rarest terms that occur; a lone one is both."""
    known = flat.join(maybe_broadcast(frequency), "term_id", "left")
    ranked = known.groupBy("ik").agg(F.array_sort(F.collect_list(F.struct("p", F.coalesce("df", F.lit(0)).alias("df"), "term_id"))).alias("terms"))
    starts = F.sequence(F.lit(0), F.greatest(F.size("terms") - window, F.lit(0)))

    def rarest(s: Column) -> Column:
        occurring = F.filter(F.slice("terms", s + 1, window), lambda x: x["df"] > 0)
        return F.slice(F.array_sort(F.transform(occurring, lambda x: F.struct(x["df"], x["p"], x["term_id"]))), 1, 2)

    one, two = F.col("w")[0], F.element_at("w", -1)
    return (
        ranked.select("ik", F.explode(F.transform(starts, rarest)).alias("w"))
        .filter(F.size("w") > 0)
        .select("ik", one["term_id"].alias("t1"), one["p"].alias("p1"), two["term_id"].alias("t2"), two["p"].alias("p2"))
        .distinct()
    )


def _meetings(postings: DataFrame, probes: DataFrame, slop: int) -> DataFrame:
    """dk, ik, delta (where the item's first word would stand), gap: the second rarest term
    is `gap` positions from its place. Positions are joined by blocks of 2 * slop + 1, so
    that a posting meets only those near it."""
    block = 2 * slop + 1
    place = F.col("delta") + F.col("p2")
    blocks = F.array_distinct(F.array(F.floor((place - slop) / block), F.floor((place + slop) / block)))
    first = (
        postings.join(maybe_broadcast(probes), F.col("term_id") == F.col("t1"))
        .select("dk", "ik", (F.col("pos") - F.col("p1")).alias("delta"), "t2", "p2")
        .withColumn("block", F.explode(blocks))
    )
    seconds = maybe_broadcast(probes.select(F.col("t2").alias("term_id")).distinct())
    second = postings.join(seconds, "term_id", "left_semi").select(
        F.col("dk").alias("dk2"), F.col("term_id").alias("term2"), F.col("pos").alias("pos2"), F.floor(F.col("pos") / block).alias("block2")
    )
    met = first.join(second, (F.col("dk") == F.col("dk2")) & (F.col("t2") == F.col("term2")) & (F.col("block") == F.col("block2")))
    gap = F.abs(F.col("pos2") - place)
    return met.filter(gap <= slop).groupBy("dk", "ik", "delta").agg(F.min(gap).alias("gap"))


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    slop: int = SLOP,
) -> DataFrame:
    """id, n_words, n_hit, items, near_items, best_match, document_key: a row for each document row, by an index of its own."""
    spark = docs.sparkSession
    index = PositionalIndex.build(docs, new_shared_path(spark, "postings"), id_col, text_col)
    found = maybe_broadcast(cut_lineage(index.search(benchmark, window, item_col, item_text_col, slop)).withColumnRenamed("dk", "key"))
    none = F.array().cast("array<string>")
    result = cut_lineage(
        index.documents()
        .join(found, F.col("dk") == F.col("key"), "left")
        .select(
            F.col("doc").alias(id_col),
            "n_words",
            F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.coalesce("items", none).alias("items"),
            F.coalesce("near_items", none).alias("near_items"),
            F.coalesce("best_match", F.lit(0.0)).alias("best_match"),
            F.col("dk").alias("document_key"),
        )
    )
    delete_path(spark, index.path)
    return result
