"""Similar sequence pairs: a seed join and ungapped extension.

The operation is "all significant local matches between queries and references", by the
published seed-and-extend method with Karlin-Altschul statistics; scores are ungapped.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqloom.operators.merge import limit_targets
from seqloom.sources.scratch import materialize

#: Letters of the blocks of a sequence that is cut into seeds: first long ones, then short ones.
BLOCKS = (4096, 64)
#: Places of the references from which on a seed is met by runs, not place by place; references' places in one share of such a join.
OFTEN, SHARE = 64, 4096
#: Stands for "the seed next to this one is met place by place, or is none".
_OPEN = 0
#: Residues with like chemistry share a letter in the reduced alphabet.
GROUPS = ["AGPST", "C", "DENQ", "FWY", "HKR", "ILMV"]


@dataclass(frozen=True)
class Sensitivity:
    """``k``: seed length; ``reduced``: seeds over groups of residues; ``min_seeds``: on one diagonal; ``max_df``: sequences that may hold a seed (None: any number, nothing is masked)."""

    k: int
    reduced: bool
    min_seeds: int
    max_df: int | None = None


PRESETS = {
    "fast": Sensitivity(6, False, 2),
    "sensitive": Sensitivity(5, False, 2),
    "very-sensitive": Sensitivity(4, False, 3),
    "ultra-sensitive": Sensitivity(6, True, 2),
}


def reduce_alphabet(sequence: Column) -> Column:
    return F.translate(sequence, "".join(GROUPS), "".join(g[0] * len(g) for g in GROUPS))


def _windows(sequences: DataFrame, k: int, reduced: bool) -> DataFrame:
    """(id, pos, w): every k letters, from position 1, between the letters next to them (a blank at an end)."""
    letters = reduce_alphabet(F.col("sequence")) if reduced else F.col("sequence")
    # With a blank at either end every seed has a letter on both sides.
    parts = sequences.where(F.length("sequence") >= k).select("id", F.lit(0).alias("off"), F.concat(F.lit(" "), letters, F.lit(" ")).alias("s"))
    wide = k + 2
    # Blocks first: finding a place in a string takes time in proportion to the place, and a row is copied for each seed.
    for size in BLOCKS:
        blocks = parts.select("id", "off", "s", F.explode(F.sequence(F.lit(0), F.floor((F.length("s") - wide) / size).cast("int"))).alias("b"))
        parts = blocks.select("id", (F.col("off") + F.col("b") * size).alias("off"), F.substring("s", F.col("b") * size + 1, F.lit(size + wide - 1)).alias("s"))
    at = parts.select("id", "off", "s", F.explode(F.sequence(F.lit(1), F.length("s") - (wide - 1))).alias("at"))
    return at.select("id", (F.col("off") + F.col("at")).alias("pos"), F.substring("s", F.col("at"), F.lit(wide)).alias("w"))


def _places(windows: DataFrame, k: int) -> DataFrame:
    """(id, pos, seed, before, after) from ``windows(id, pos, w)``."""
    edge = lambda n: F.rtrim(F.substring("w", n, 1))
    return windows.select("id", "pos", F.substring("w", 2, k).alias("seed"), edge(1).alias("before"), edge(k + 2).alias("after"))


def seeds(sequences: DataFrame, k: int, reduced: bool = False) -> DataFrame:
    """(id, pos, seed, before, after): every k letters, from position 1, and the letters ahead of and behind them ('' at an end)."""
    return _places(_windows(sequences, k, reduced), k)


def build_seed_index(refs: DataFrame, k: int, reduced: bool = False, path: str | None = None) -> DataFrame:
    """The references' seeds, written once if ``path`` is given so that many query runs can use them."""
    index = seeds(refs, k, reduced)
    if path is None:
        return index
    index.repartition("seed").sortWithinPartitions("seed").write.mode("overwrite").parquet(path)
    return refs.sparkSession.read.parquet(path)


def mask_frequent_seeds(index: DataFrame, max_df: int) -> DataFrame:
    """Without seeds that stand in more than ``max_df`` sequences (low-complexity repeats): this is what bounds the join."""
    often = index.select("seed", "id").distinct().groupBy("seed").agg(F.count("*").alias("df")).where(F.col("df") > max_df)
    return index.join(often.select("seed"), "seed", "left_anti")


def _hashed(places: DataFrame, k: int) -> DataFrame:
    """Places with 64-bit hashes of the seed and of the seeds one place to the left and to the right (null at an end)."""
    near = lambda letter, seed: F.when(F.col(letter) != "", F.xxhash64(seed))
    return places.select(
        "id", "pos", F.xxhash64("seed").alias("seed"), near("before", F.concat("before", F.substring("seed", 1, k - 1))).alias("left"), near("after", F.concat(F.substring("seed", 2, k - 1), "after")).alias("right")
    )


def _tagged(rows: DataFrame, often: DataFrame) -> DataFrame:
    """Rows of seeds that stand often, with the seed to either side only where it stands often, too; else ``_OPEN``."""
    out = rows.join(often.select("seed"), "seed", "left_semi")
    for side in ("left", "right"):
        known = often.select(F.col("seed").alias(side), F.lit(True).alias("known"))
        out = out.join(known, side, "left").withColumn(side, F.when(F.col("known"), F.col(side)).otherwise(F.lit(_OPEN))).drop("known")
    return out


def _run_ends(q: DataFrame, s: DataFrame, side: str, share: int) -> DataFrame:
    """(query_id, subject_id, qpos, diagonal) of pairs of places with one seed that are not followed, on ``side``, by another such pair.

    Two places with one seed have the same seed next to them only if the letter there is the same, so a query's place meets
    just the references' places whose next seed differs; these are found by an equi-join on (seed, next seed), as a
    seed has few next seeds, one a letter.  Pairs inside a run are never made.  References' places of
    one key are dealt to shares of about ``share`` places, and queries' places are copied for each.
    """
    tags = s.groupBy("seed", F.col(side).alias("tag")).agg(F.count("*").alias("n"))
    shares = F.ceil(F.col("n") / share).cast("int")
    facing = tags.groupBy("seed").agg(F.collect_list(F.struct("tag", shares.alias("shares"))).alias("tags"))
    differs = lambda t: (t["tag"] == _OPEN) | (t["tag"] != F.col(side))
    wanted = q.join(facing, "seed").select("query_id", "qpos", "seed", F.explode(F.filter("tags", differs)).alias("t"))
    wanted = wanted.select("query_id", "qpos", "seed", F.col("t.tag").alias("tag"), F.explode(F.sequence(F.lit(1), F.col("t.shares"))).alias("part"))
    dealt = s.join(tags.select("seed", F.col("tag").alias(side), shares.alias("shares")), ["seed", side]).select(
        "subject_id", "spos", "seed", F.col(side).alias("tag"), (F.pmod(F.xxhash64("subject_id", "spos"), F.col("shares")) + 1).cast("int").alias("part")
    )
    return wanted.join(dealt, ["seed", "tag", "part"]).select("query_id", "subject_id", "qpos", (F.col("qpos") - F.col("spos")).alias("diagonal"))


def seed_matches(queries: DataFrame, index: DataFrame, k: int, reduced: bool = False, often: int = OFTEN, share: int = SHARE) -> DataFrame:
    """(query_id, subject_id, diagonal, n), whose sums of n are the numbers of common seeds on a diagonal.

    A seed at fewer than ``often`` places of the index gives a row for each pair of places.  A more frequent one is lengthened: along a diagonal such
    seeds make runs, and only a run's two ends give a row, 1 - first place and last place, whatever its
    length.  So a repeat that all sequences share costs a few rows a pair of sequences, not one a letter.
    """
    # Seeds meet by a 64-bit hash, which is less to shuffle and to compare than letters.
    # The index is written, so that Spark knows its size: a small one is broadcast, and no seed of the queries is shuffled.
    s = materialize(_hashed(index, k).withColumnsRenamed({"id": "subject_id", "pos": "spos"}), "reference-places")
    known = s.select("seed").distinct()
    # Most seeds of a query are no seed of a reference, and only of the others the seeds next to them are wanted.
    met = _windows(queries, k, reduced).withColumn("seed", F.xxhash64(F.substring("w", 2, k))).join(known, "seed", "left_semi").drop("seed")
    q = _hashed(_places(met, k), k).withColumnsRenamed({"id": "query_id", "pos": "qpos"})
    frequent = materialize(s.groupBy("seed").agg(F.count("*").alias("n")).where(F.col("n") >= often), "frequent-seeds")
    one = F.lit(1).cast("long").alias("n")
    diagonal = (F.col("qpos") - F.col("spos")).alias("diagonal")
    if frequent.isEmpty():
        return q.select("query_id", "qpos", "seed").join(s.select("subject_id", "spos", "seed"), "seed").select("query_id", "subject_id", diagonal, one)
    q = materialize(q, "query-places")  # read twice from here on
    rare = q.select("query_id", "qpos", "seed").join(s.join(frequent, "seed", "left_anti").select("subject_id", "spos", "seed"), "seed").select("query_id", "subject_id", diagonal, one)
    fq, fs = materialize(_tagged(q, frequent), "query-seeds"), materialize(_tagged(s, frequent), "reference-seeds")
    begins = _run_ends(fq, fs, "left", share).select("query_id", "subject_id", "diagonal", (F.lit(1) - F.col("qpos")).cast("long").alias("n"))
    ends = _run_ends(fq, fs, "right", share).select("query_id", "subject_id", "diagonal", F.col("qpos").cast("long").alias("n"))
    return rare.unionByName(begins).unionByName(ends)


def seed_join(queries: DataFrame, index: DataFrame, k: int, min_seeds: int, reduced: bool = False, often: int = OFTEN) -> DataFrame:
    """(query_id, subject_id, diagonal, n_seeds): pairs with ``min_seeds`` common seeds on a diagonal; see ``seed_matches``."""
    matches = seed_matches(queries, index, k, reduced, often)
    return matches.groupBy("query_id", "subject_id", "diagonal").agg(F.sum("n").alias("n_seeds")).where(F.col("n_seeds") >= min_seeds)


def rule_scores(same: int = 5, alike: int = 1, other: int = -2) -> dict[tuple[str, str], int]:
    """Substitution scores by rule: same residue, same group, or neither."""
    letters = "".join(GROUPS)
    group = {a: i for i, g in enumerate(GROUPS) for a in g}
    return {(a, b): same if a == b else alike if group[a] == group[b] else other for a in letters for b in letters}


def read_scores(path: str) -> dict[tuple[str, str], int]:
    """A substitution matrix in the common text format: a row of letters, then a letter and its scores a row."""
    rows = [line.split() for line in open(path, encoding="ascii") if line.strip() and not line.startswith("#")]
    return {(r[0], c): int(v) for r in rows[1:] for c, v in zip(rows[0], r[1:])}


def extend_ungapped(candidates: DataFrame, queries: DataFrame, refs: DataFrame, scores: dict[tuple[str, str], int] | None = None) -> DataFrame:
    """The best-scoring stretch of each candidate's diagonal: the merged hits' columns but e-value and bit score, and ``score``.

    The maximal sum is found in one pass over the diagonal that keeps where the running stretch began.
    """
    table = scores or rule_scores()
    lookup = F.create_map(*[x for (a, b), v in sorted(table.items()) for x in (F.lit(a + b), F.lit(v))])
    q = queries.select(F.col("id").alias("query_id"), F.col("sequence").alias("qs"))
    s = refs.select(F.col("id").alias("subject_id"), F.col("sequence").alias("ss"))
    both = candidates.join(q, "query_id").join(s, "subject_id")
    begin = F.greatest(F.lit(0), -F.col("diagonal"))  # places of the subject ahead of the common part
    size = F.least(F.length("ss") - begin, F.length("qs") - begin - F.col("diagonal"))
    cut = both.withColumn("sbegin", begin.cast("int")).withColumn("qbegin", (begin + F.col("diagonal")).cast("int")).withColumn("size", size.cast("int")).where("size > 0")
    letters = cut.withColumn("a", F.split(F.expr("substring(qs, qbegin + 1, size)"), "")).withColumn("b", F.split(F.expr("substring(ss, sbegin + 1, size)"), ""))
    low = min(table.values())
    points = F.zip_with("a", "b", lambda x, y: F.coalesce(F.element_at(lookup, F.concat(x, y)), F.lit(low)))
    scored = letters.withColumn("points", points)
    start = F.struct(*[F.lit(0).alias(n) for n in ("at", "sum", "from", "best", "lo", "hi")])

    def step(acc: Column, p: Column) -> Column:
        total = F.when(acc["sum"] > 0, acc["sum"]).otherwise(F.lit(0)) + p
        begun = F.when(acc["sum"] > 0, acc["from"]).otherwise(acc["at"])
        up = total > acc["best"]
        return F.struct(
            (acc["at"] + 1).alias("at"), total.alias("sum"), begun.alias("from"), F.when(up, total).otherwise(acc["best"]).alias("best"),
            F.when(up, begun).otherwise(acc["lo"]).alias("lo"), F.when(up, acc["at"] + 1).otherwise(acc["hi"]).alias("hi"),
        )

    best = scored.withColumn("m", F.aggregate("points", start, step)).where("m.best > 0")
    n = (F.col("m.hi") - F.col("m.lo")).alias("alignment_length")
    stretch = lambda c: F.slice(c, F.col("m.lo") + 1, F.col("m.hi") - F.col("m.lo"))
    same = best.withColumn("same", F.size(F.filter(F.zip_with(stretch("a"), stretch("b"), lambda x, y: x == y), lambda z: z)))
    return same.select(
        "query_id", "subject_id", (100.0 * F.col("same") / n).alias("percent_identity"), n, (n - F.col("same")).cast("int").alias("mismatches"), F.lit(0).alias("gap_opens"),
        (F.col("qbegin") + F.col("m.lo") + 1).alias("query_start"), (F.col("qbegin") + F.col("m.hi")).alias("query_end"),
        (F.col("sbegin") + F.col("m.lo") + 1).alias("subject_start"), (F.col("sbegin") + F.col("m.hi")).alias("subject_end"), F.col("m.best").alias("score"), "n_seeds",
    )


def score_evalue(hits: DataFrame, queries: DataFrame, refs: DataFrame, lam: float = 0.3176, k: float = 0.134) -> DataFrame:
    """``hits`` with ``bitscore`` and ``evalue``; the database is the whole reference, however it is chunked."""
    m = queries.select(F.col("id").alias("query_id"), F.length("sequence").alias("_m"))
    total = refs.agg(F.coalesce(F.sum(F.length("sequence")), F.lit(0)).alias("_n"))
    bits = (F.lit(lam) * F.col("score") - F.log(F.lit(k))) / F.log(F.lit(2.0))
    out = hits.join(m, "query_id").crossJoin(F.broadcast(total))  # one row
    return out.withColumn("bitscore", bits).withColumn("evalue", F.col("_m").cast("double") * F.col("_n") * F.pow(F.lit(2.0), -bits)).drop("_m", "_n")


def align(queries: DataFrame, refs: DataFrame, sensitivity: str | Sensitivity = "very-sensitive", max_target_seqs: int = 50, max_evalue: float = 10.0, scores: dict | None = None) -> DataFrame:
    """Hits of queries against references.  ``refs`` may have ``ref_chunk_id``; each (query, reference chunk) keeps its best targets."""
    p = PRESETS[sensitivity] if isinstance(sensitivity, str) else sensitivity
    index = build_seed_index(refs, p.k, p.reduced)
    if p.max_df is not None:
        index = mask_frequent_seeds(index, p.max_df)
    hits = score_evalue(extend_ungapped(seed_join(queries, index, p.k, p.min_seeds, p.reduced), queries, refs, scores), queries, refs).where(F.col("evalue") <= max_evalue)
    if "ref_chunk_id" in refs.columns:
        hits = hits.join(refs.select(F.col("id").alias("subject_id"), "ref_chunk_id"), "subject_id")
    else:
        hits = hits.withColumn("ref_chunk_id", F.lit("ref_000"))
    return limit_targets(hits, max_target_seqs)
