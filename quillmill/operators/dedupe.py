"""Deduplication and canonical values."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmill.functions.text import normalise_key, token_set
from quillmill.session import cut_lineage, maybe_broadcast


def first_per_key(df: DataFrame, keys: list[str | Column], order: list[Column]) -> DataFrame:
    """The first row of each key; `order` must make the order total. Only one row a key and task is shuffled."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(w)).filter("_nth = 1").drop("_nth")


def invoice_dedupe(df: DataFrame, description: str, amounts: list[str], preferred: Column, order: list[str]) -> DataFrame:
    """One row for each (lowered description, amounts): the first preferred one, else the first."""
    keys = [F.lower(F.trim(F.col(description)))] + [F.trim(F.col(a).cast("string")) for a in amounts]
    return first_per_key(df, keys, [F.when(preferred, 0).otherwise(1), *[F.col(c) for c in order]])


def paragraph_dedupe(df: DataFrame, parent: list[str], text: str, order: str, is_paragraph: Column | None = None) -> DataFrame:
    """Within one parent the first of equal paragraphs; rows that are no paragraphs stay."""
    w = Window.partitionBy(*parent, text).orderBy(order)
    keep = F.col("_nth") == 1
    if is_paragraph is not None:
        keep = keep | ~is_paragraph
    return df.withColumn("_nth", F.row_number().over(w)).filter(keep).drop("_nth")


def canonical_variant(df: DataFrame, group: list[str], name: str) -> DataFrame:
    """group, canonical, n: the commonest variant; ties go to the longest, then to the least."""
    counts = df.groupBy(*group, name).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*group).orderBy(F.desc("n"), F.desc(F.length(name)), name)
    return counts.withColumn("_r", F.row_number().over(w)).filter("_r = 1").select(*group, F.col(name).alias("canonical"), "n")


def mode_with_share(df: DataFrame, group: list[str], value: str) -> DataFrame:
    """group, value, votes, agreement_bp: the commonest value (least on ties) and its share in hundredths of a percent."""
    counts = df.groupBy(*group, value).agg(F.count(F.lit(1)).alias("votes"))
    best = counts.groupBy(*group).agg(
        F.max_by(F.struct(value, "votes"), F.struct("votes", (-F.col(value)).alias("v"))).alias("b"), F.sum("votes").alias("all")
    )
    return best.select(*group, f"b.{value}", "b.votes", F.floor(F.col("b.votes") * 10000 / F.col("all")).cast("long").alias("agreement_bp"))


def contract_sets(df: DataFrame, description: str, contract: str, out: str = "contracts") -> DataFrame:
    """description, sorted distinct contracts."""
    return df.groupBy(F.trim(description).alias(description)).agg(F.array_sort(F.collect_set(contract)).alias(out))


def prefix_pairs(left: DataFrame, right: DataFrame, kept: Callable[[Column], Column], right_kept: Callable[[Column], Column] | None = None) -> DataFrame:
    """name_a, words_a, name_b, words_b: pairs of (name, words) whose rarest words meet, each pair once.

    Words are ordered by rarity over both sides; only the first kept(n) of a left row's n
    words (and right_kept(n) of a right row's, all by default) are joined, so a word that
    nearly all rows share is joined only for rows that have hardly another. A pair is kept
    for the first of its meeting words, so nothing is grouped.
    """
    both = left.select("words").unionAll(right.select("words"))
    rarity = both.select(F.explode("words").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df"))

    def ordered(df: DataFrame, keep: Callable[[Column], Column] | None, tag: str) -> DataFrame:
        flat = df.select("name", F.explode("words").alias("word")).join(maybe_broadcast(cut_lineage(rarity)), "word")
        sets = flat.groupBy("name").agg(F.array_sort(F.collect_list(F.struct("df", "word"))).alias("_s"))
        words = sets.select(F.col("name").alias(f"name_{tag}"), F.transform("_s", lambda s: s["word"]).alias(f"words_{tag}"))
        n = F.size(f"words_{tag}")
        return words.withColumn(f"prefix_{tag}", F.slice(f"words_{tag}", F.lit(1), F.greatest(keep(n).cast("int"), F.lit(0)) if keep else n))

    a, b = ordered(left, kept, "a"), ordered(right, right_kept, "b")
    met = a.withColumn("word", F.explode("prefix_a")).join(b.withColumn("word", F.explode("prefix_b")), "word")
    first = F.array_intersect("prefix_a", "prefix_b")[0] == F.col("word")
    return met.filter(first).select("name_a", "words_a", "name_b", "words_b")


def candidate_pairs(described: DataFrame, name: str, contracts: str) -> DataFrame:
    """name_a < name_b, shared, smaller: pairs that share at least half of the smaller one's words and no contract.

    Of n words at least half are shared, so one of the rarest n - ceil(n / 2) + 1 words of
    the smaller set is: those are joined with the words of the larger sets.
    """
    words = cut_lineage(described.select(F.col(name).alias("name"), token_set(F.col(name)).alias("words")).filter(F.size("words") > 0))
    met = prefix_pairs(words, words, lambda n: n - F.ceil(n / 2) + 1)
    smaller = (F.size("words_a") < F.size("words_b")) | ((F.size("words_a") == F.size("words_b")) & (F.col("name_a") < F.col("name_b")))
    shared = F.size(F.array_intersect("words_a", "words_b"))
    pairs = met.filter(smaller).select(
        F.least("name_a", "name_b").alias("name_a"), F.greatest("name_a", "name_b").alias("name_b"), shared.cast("long").alias("shared"), F.size("words_a").cast("long").alias("smaller")
    ).filter("2 * shared >= smaller")
    left = described.select(F.col(name).alias("name_a"), F.col(contracts).alias("c_a"))
    right = described.select(F.col(name).alias("name_b"), F.col(contracts).alias("c_b"))
    apart = ~F.coalesce(F.arrays_overlap("c_a", "c_b"), F.lit(False))
    return pairs.join(left, "name_a").join(right, "name_b").filter(apart).select("name_a", "name_b", "shared", "smaller")


def merge_by_key(df: DataFrame, name: str) -> DataFrame:
    """norm_key, canonical (longest, then least), members: values that are equal but for case, punctuation and word order."""
    return (
        df.select(name, normalise_key(F.col(name)).alias("norm_key"))
        .distinct()
        .groupBy("norm_key")
        .agg(F.min_by(name, F.struct(-F.length(name), name)).alias("canonical"), F.count(F.lit(1)).alias("members"))
    )


def name_clusters(df: DataFrame, name: str, ratio: float = 0.55) -> DataFrame:
    """name, canonical, n: greedy clusters of names with the same first word.

    Names of at least two words, the commonest first, join the first cluster whose head
    is alike by difflib's ratio. Names are counted first, so a group holds distinct names only.
    """
    import difflib

    import pandas as pd

    counted = df.filter(F.col(name).isNotNull()).groupBy(F.col(name).alias("name")).agg(F.count(F.lit(1)).alias("n"))
    first = F.lower(F.split(F.trim("name"), r"\s+")[0])

    def cluster(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["n", "name"], ascending=[False, True])
        heads: list[str] = []
        out = []
        for value in rows["name"]:
            home = value
            if len(value.split()) >= 2:
                alike = (h for h in heads if difflib.SequenceMatcher(None, h.lower(), value.lower()).ratio() >= ratio)
                home = next(alike, None)
                if home is None:
                    heads.append(home := value)
            out.append(home)
        return pd.DataFrame({"name": rows["name"], "canonical": out, "n": rows["n"]})

    return counted.withColumn("first", first).groupBy("first").applyInPandas(cluster, "name string, canonical string, n long")


def split_by_cooccurrence(groups: DataFrame, group: str, name: str, contracts: str) -> DataFrame:
    """group, name, subgroup: members in order join the first subgroup with which they share no contract."""
    import pandas as pd

    def split(rows: pd.DataFrame) -> pd.DataFrame:
        taken: list[set] = []
        out = []
        for mine in rows.sort_values(name)[contracts]:
            mine = set(mine if mine is not None else [])
            at = next((i for i, t in enumerate(taken) if not t & mine), len(taken))
            if at == len(taken):
                taken.append(set())
            taken[at] |= mine
            out.append(at)
        ordered = rows.sort_values(name)
        return pd.DataFrame({group: ordered[group], name: ordered[name], "subgroup": out})

    kind = groups.schema[group].dataType.simpleString()
    return groups.groupBy(group).applyInPandas(split, f"`{group}` {kind}, `{name}` string, subgroup int")


def lcs_similarity(a: Column, b: Column) -> Column:
    """2 * longest common subsequence / total length, by one fold over the first text's characters."""
    chars_a, chars_b = F.split(a, ""), F.split(b, "")
    n = F.length(b)
    zero = F.array_repeat(F.lit(0), (n + 1).cast("int"))

    def row(before: Column, c: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(1), n),
            F.array(F.lit(0)),
            lambda acc, j: F.array_append(
                acc,
                F.when(F.get(chars_b, j - 1) == c, F.get(before, j - 1) + 1).otherwise(F.greatest(F.get(before, j), F.get(acc, j - 1))),
            ),
        )

    last = F.element_at(F.aggregate(chars_a, zero, row), -1)
    return F.when((F.length(a) > 0) & (F.length(b) > 0), 2.0 * last / (F.length(a) + n)).otherwise(F.lit(0.0))


def fuzzy_match(values: DataFrame, candidates: DataFrame, least: float = 0.85) -> DataFrame:
    """value, matched, score: of the candidates at least half as long as a value (and it of them) the one that is most
    alike by lcs_similarity(), if it reaches `least` (0.85 or more); the first in order of equals.

    values: value. candidates: candidate, ord. From 0.85 on two texts that differ share two
    neighbouring characters, so pairs are found through those and no others are compared.
    """
    bare = lambda c: F.lower(F.trim(F.regexp_replace(c, r"\s+", " ")))
    pairs = lambda t: F.concat(F.array(t), F.transform(F.sequence(F.lit(1), F.greatest(F.length(t) - 1, F.lit(1))), lambda i: F.substring(t, i, F.lit(2))))
    of = lambda df, c: cut_lineage(df.filter(bare(F.col(c)) != "").select(F.col(c).alias("name"), F.array_distinct(pairs(bare(F.col(c)))).alias("words")).distinct())
    met = prefix_pairs(of(values, "value"), of(candidates, "candidate"), lambda n: n)
    a, b = bare(F.col("name_a")), bare(F.col("name_b"))
    near = met.filter(2 * F.least(F.length(a), F.length(b)) >= F.greatest(F.length(a), F.length(b)))
    scored = near.withColumn("score", F.when(a == b, F.lit(1.0)).otherwise(lcs_similarity(a, b))).filter(F.col("score") >= least)
    ranked = scored.join(candidates.groupBy(F.col("candidate").alias("name_b")).agg(F.min("ord").alias("ord")), "name_b")
    return ranked.groupBy(F.col("name_a").alias("value")).agg(
        F.min_by(F.trim("name_b"), F.struct((-F.col("score")).alias("s"), "ord")).alias("matched"), F.max("score").alias("score")
    )
