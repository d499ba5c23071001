"""Near-duplicate texts by an inverted join over signature coordinates.

Method: texts with the same set of shingles form a class. Each class posts its
MinHash coordinates; of those that other classes have too, it may lack all but
a few before it is no partner of anybody, so only its rarest ones (the prefix
of the frequency order) are joined and its frequent ones are skipped. Pairs that
meet there count their common coordinates; those with enough (``least_match``)
are compared on the full sets.

Only links between different texts matter for the groups. First every class is
compared with a few centres of each of its lists, the likeliest first; then only
classes of one list that are not yet connected are compared with each other,
which is exact and leaves large groups of copies linear. Two sketches, kept for
the classes that are posted, tell which pairs can reach the similarity before full
sets are moved: the parities of 1,024 cells that the shingles fall into, and one
bit each of 1,024 further MinHash values. Two sets differ in no more parities than
shingles, so the first loses no pair; it is sharp for sets of some hundred shingles,
the second for large ones.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotflow.llm.common import map_arrow, table
from lotflow.llm.components import components
from lotflow.llm.words import BLANK_CUT, mix, runs, word_chunks
from lotflow.session import materialize

#: Coordinates of a signature, and the chance that a pair at the similarity asked for shares fewer than it must.
COORDINATES, MATCH_LOSS = 24, 1e-5
#: Bits of the sketch, and the chance that such a pair differs in more than it may.
BITS, BITS_LOSS = 1024, 1e-6
#: Classes of a list that are compared in one piece; longer lists are compared in pieces of about so many each.
LIST = 4096
#: Passes before the exact one; centres of a list in each, and the likeliest of its centres that a class is compared with.
PASSES, CENTRES, FIRST = 1, 8, 3
_RANDOM = np.random.Generator(np.random.PCG64(77))
_FACTOR = _RANDOM.integers(1, 1 << 63, COORDINATES, dtype=np.uint64) | np.uint64(1)
_SHIFT = _RANDOM.integers(1, 1 << 63, COORDINATES, dtype=np.uint64)
_BIT_FACTOR = _RANDOM.integers(1, 1 << 63, BITS, dtype=np.uint64) | np.uint64(1)
_BIT_SHIFT = _RANDOM.integers(1, 1 << 63, BITS, dtype=np.uint64)


def _chances(n: int, p: float) -> list[float]:
    """The chances of 0 to ``n`` hits."""
    if p in (0, 1):
        return [float(i == n * p) for i in range(n + 1)]
    whole, hit, miss = math.lgamma(n + 1), math.log(p), math.log1p(-p)
    return [math.exp(whole - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * hit + (n - i) * miss) for i in range(n + 1)]


def least_match(percent: int) -> int:
    """Coordinates that a pair must share: 10 of 24 at 80, where fewer have a chance of 6.7e-6."""
    lost, match = 0.0, 0
    for chance in _chances(COORDINATES, percent / 100):
        lost += chance
        if lost >= MATCH_LOSS:
            break
        match += 1
    if not match:
        raise ValueError(f"a similarity of {percent} percent is too low for {COORDINATES} coordinates")
    return match


def most_unlike(percent: int) -> int:
    """Sketch bits in which a pair may differ: 151 of 1,024 at 80, where more have a chance below 1e-6."""
    lost, most = 0.0, BITS
    for chance in reversed(_chances(BITS, (1 - percent / 100) / 2)):
        lost += chance
        if lost >= BITS_LOSS:
            break
        most -= 1
    return most


def shingle_sets(batch, name: str, size: int):
    """For each text of a batch its number among them and its sorted distinct shingle hashes."""
    for begin, hashes, bounds in word_chunks(batch.column(name), BLANK_CUT):
        grams = runs(hashes, size)
        for k, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
            if b - a >= size:
                yield begin + k, np.unique(grams[a : b - size + 1])
            elif b > a:
                yield begin + k, runs(hashes[a:b], b - a)
            else:
                yield begin + k, np.zeros(0, np.uint64)


def digest(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits of a set."""
    one = np.add.reduce(mix(shingles ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)
    two = np.add.reduce(mix(shingles + np.uint64(0x14057B7EF767814F)), dtype=np.uint64)
    return int(one.astype(np.int64)), int(two.astype(np.int64))


def signature(shingles: np.ndarray) -> np.ndarray:
    """The smallest of the set's values under each coordinate's hash function, their upper 32 bits."""
    out = np.empty(COORDINATES, np.int32)
    for k in range(COORDINATES):
        out[k] = (((shingles ^ _SHIFT[k]) * _FACTOR[k]).min() >> np.uint64(32)).astype(np.uint32).view(np.int32)
    return out


def bit_sketch(shingles: np.ndarray) -> np.ndarray:
    """A bit of the smallest value under each of BITS hash functions, in numbers of 64 bits."""
    least, step = np.empty(BITS, np.uint64), max(1, min(BITS, 500_000 // len(shingles)))
    for k in range(0, BITS, step):
        values = shingles[:, None] ^ _BIT_SHIFT[k : k + step]
        values *= _BIT_FACTOR[k : k + step]
        least[k : k + step] = values.min(axis=0)
    return np.packbits((mix(least) & np.uint64(1)).astype(np.uint8)).view(np.int64)


def odd_sketch(shingles: np.ndarray) -> np.ndarray:
    """Whether each of BITS cells holds an odd number of shingles, in numbers of 64 bits."""
    cells = mix(shingles ^ np.uint64(0x2545F4914F6CDD1D)) % np.uint64(BITS)
    return np.packbits((np.bincount(cells.astype(np.int64), minlength=BITS) & 1).astype(np.uint8)).view(np.int64)


SKETCH = "id bigint, t bigint, n bigint, d1 bigint, d2 bigint, sig array<int>"


def sketches(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """Hash of the text, set size, digest and signature of every text; the signature of an empty set is null."""

    def make():
        def step(batch):
            out = {"id": batch.column("id"), "t": batch.column("t"), "n": [], "d1": [], "d2": [], "sig": []}
            for _, own in shingle_sets(batch, "text", size):
                one, two = digest(own)
                for k, v in (("n", len(own)), ("d1", one), ("d2", two), ("sig", signature(own) if len(own) else None)):
                    out[k].append(v)
            return out

        return step

    return map_arrow(docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("t"), F.col(text_col).alias("text")), SKETCH, make)


def postings(classes: DataFrame, match: int) -> DataFrame:
    """``key, c, n, keys``: the prefix of each class that shares ``match`` coordinate values or more with others.

    ``keys`` holds all shared ones of the class, at most COORDINATES.
    """
    every = classes.select("c", "n", F.posexplode("sig").alias("k", "v"))
    every = every.select("c", "n", (F.col("k") * F.lit(1 << 32) + F.col("v").cast("long")).alias("key"))
    common = every.groupBy("key").count().where("count > 1")
    own = every.join(common, "key").groupBy("c", "n").agg(F.sort_array(F.collect_list(F.struct("count", "key"))).alias("shared"))
    own = own.where(F.size("shared") >= match).select("c", "n", F.col("shared.key").alias("keys"))
    return own.select("c", "n", "keys", F.explode(F.slice("keys", F.lit(1), F.size("keys") - match + 1)).alias("key"))


def _unlike(a: str, b: str):
    """Number of different sketch bits."""
    return sum((F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(BITS // 64)), F.lit(0))


def _alike(percent: int, match: int):
    """Whether sizes and sketches allow the similarity and enough coordinates meet."""
    sizes = 100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")
    bits = _unlike("wa", "wb") <= most_unlike(percent)
    # The shingles that only one of the two has, at least. As a loop: with as many terms again the generated condition is not compiled.
    cells = F.zip_with("oa", "ob", lambda a, b: F.bit_count(a.bitwiseXOR(b)))
    apart = (100 + percent) * F.aggregate(cells, F.lit(0), lambda s, x: s + x) <= (100 - percent) * (F.col("na") + F.col("nb"))
    return sizes & F.expr("ra <> rb") & bits & apart & (F.size(F.array_intersect("ka", "kb")) >= match)


def _side(posted: DataFrame, x: str, *more: Column) -> DataFrame:
    names = {"c": x, "n": f"n{x}", "keys": f"k{x}", "bits": f"w{x}", "odd": f"o{x}", "root": f"r{x}"}
    return posted.select("key", *more, *(F.col(k).alias(v) for k, v in names.items()))


def unsettled(posted: DataFrame, roots: DataFrame) -> DataFrame:
    """The postings of lists whose classes are not all connected, with the root of each class and the pieces of its list."""
    rooted = posted.join(roots, posted.c == roots.node, "left").withColumn("root", F.coalesce("root", "c")).drop("node")
    split = rooted.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.ceil(F.count("*") / LIST).cast("int").alias("pieces"))
    return rooted.join(split.where("low < high").select("key", "pieces"), "key")


def star_pairs(rooted: DataFrame, percent: int, match: int, turn: int = 0) -> DataFrame:
    """Each class with the likeliest of the centres of its lists; centres are the smallest under a few hash orders."""
    row = F.struct("c", "n", "keys", "bits", "odd", "root")
    orders = [F.min(F.struct(F.xxhash64("c", F.lit(turn), F.lit(i)).alias("h"), row.alias("row"))).alias(f"s{i}") for i in range(CENTRES)]
    centres = rooted.groupBy("key").agg(*orders).select("key", F.explode(F.array_distinct(F.array(*(F.col(f"s{i}.row") for i in range(CENTRES))))).alias("s"))
    met = _side(rooted, "b").join(_side(centres.select("key", "s.*"), "a"), "key").where(_alike(percent, match))
    # At most CENTRES for each of a class's lists.
    best = met.groupBy("b", "nb").agg(F.sort_array(F.collect_set(F.struct(_unlike("wa", "wb").alias("d"), "a", "na"))).alias("all"))
    best = best.select("b", "nb", F.explode(F.slice("all", 1, FIRST)).alias("x")).select("x.a", "b", "x.na", "nb")
    ordered = F.expr("if(a < b, named_struct('a', a, 'b', b, 'na', na, 'nb', nb), named_struct('a', b, 'b', a, 'na', nb, 'nb', na))")
    return best.select(ordered.alias("p")).select("p.*").distinct()


def open_pairs(rooted: DataFrame, percent: int, match: int) -> DataFrame:
    """Classes that meet in a list and are not connected yet, each pair at the first key that both have.

    A long list is cut into pieces by a hash of the class; every two of its pieces
    meet under a key of their own.
    """
    placed = rooted.withColumn("piece", F.pmod(F.xxhash64("c"), F.col("pieces")).cast("int"))
    last = F.col("pieces") - 1
    left = placed.withColumn("other", F.explode(F.sequence("piece", last)))
    right = placed.withColumn("other", F.explode(F.sequence(F.lit(0), "piece")))
    left = _side(left, "a", F.col("piece").alias("p"), F.col("other").alias("q"))
    right = _side(right, "b", F.col("other").alias("p"), F.col("piece").alias("q"))
    met = left.join(right, ["key", "p", "q"]).where("p < q OR a < b").where(_alike(percent, match))
    met = met.where(F.array_intersect("ka", "kb")[0] == F.col("key"))
    return met.select(F.expr("if(a < b, named_struct('a', a, 'b', b, 'na', na, 'nb', nb), named_struct('a', b, 'b', a, 'na', nb, 'nb', na))").alias("x")).select("x.*")


def class_sets(docs: DataFrame, classes: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """``c, s, bits, odd``: the full set and the sketches of each of these classes, from one text that has it."""

    def make():
        def step(batch):
            out: dict[str, list] = {"c": [], "s": [], "bits": [], "odd": []}
            held = 0
            key = [batch.column(x).to_pylist() for x in ("c", "d1", "d2")]
            for i, own in shingle_sets(batch, "text", size):
                if digest(own) == (key[1][i], key[2][i]):
                    out["c"].append(key[0][i])
                    out["s"].append(own.view(np.int64))
                    out["bits"].append(bit_sketch(own))
                    out["odd"].append(odd_sketch(own))
                    held += len(own)
                if held > 500_000:  # sets take more room than their texts
                    yield out
                    out, held = {"c": [], "s": [], "bits": [], "odd": []}, 0
            yield out

        return step

    # By id and hash of the text: one id, or none, may stand for many texts.
    wanted = classes.select("c", F.col("kept.id").alias("rep"), F.col("kept.t").alias("rep_text"), "d1", "d2")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("t"), F.col(text_col).alias("text"))
    same = (F.col("t") == F.col("rep_text")) & F.col("id").eqNullSafe(F.col("rep"))
    found = texts.join(wanted.hint("shuffle_hash"), same).select("c", "d1", "d2", "text")
    sets = materialize(map_arrow(found, "c bigint, s array<bigint>, bits array<bigint>, odd array<bigint>", make), "sets")
    rows, distinct = sets.agg(F.count("*"), F.countDistinct("c")).first()
    return sets if rows == distinct else materialize(sets.dropDuplicates(["c"]), "sets")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    right = pairs.join(sets.select(F.col("c").alias("b"), F.col("s").alias("sb")), "b")
    both = right.join(sets.select(F.col("c").alias("a"), F.col("s").alias("sa")), "a")
    both = both.select("a", "b", "na", "nb", F.size(F.array_intersect("sa", "sb")).cast("long").alias("common"))
    return both.where(100 * F.col("common") >= percent * (F.col("na") + F.col("nb") - F.col("common"))).select("a", "b")


def _grouped(docs: DataFrame, size: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """``id, t, n`` of every row; ``component`` and the hash ``first`` of the text that is kept under it.

    ``first`` is null outside of groups. Rows with an id go before those without.
    """
    match = least_match(percent)
    rows = materialize(sketches(docs, id_col, text_col, size), "sketches")
    kept = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "t")).alias("kept")
    classes = rows.where("n > 0").groupBy("d1", "d2", "n").agg(kept, F.count("*").alias("copies"), F.first("sig").alias("sig"))
    # Numbered as written: classes of different texts may have one id, or none.
    classes = materialize(classes.withColumn("c", F.monotonically_increasing_id()), "classes")
    posted = materialize(postings(classes, match), "postings")
    sets = class_sets(docs, classes.join(posted.select("c").distinct(), "c", "left_semi"), id_col, text_col, size)
    posted = materialize(posted.join(sets.select("c", "bits", "odd"), "c"), "postings")
    rooted, links, roots = posted.withColumn("root", F.col("c")), None, None
    for turn in range(PASSES + 1):
        pairs = star_pairs(rooted, percent, match, turn) if turn < PASSES else open_pairs(rooted, percent, match)
        found = materialize(confirm(pairs, sets, percent), "links")
        links = found if links is None else links.union(found)
        roots = materialize(components(links), "roots")
        if turn < PASSES:
            rooted = materialize(unsettled(posted, roots), "unsettled")

    rooted = classes.join(roots, classes.c == roots.node, "left").select("d1", "d2", "n", "kept", "copies", "root")
    least = rooted.where("root IS NOT NULL").groupBy("root").agg(F.min("kept").alias("least"))
    grouped = rooted.where("root IS NOT NULL OR copies > 1").join(least, "root", "left").select("d1", "d2", "n", F.coalesce("least", "kept").alias("kept"))
    out = rows.select("id", "t", "n", "d1", "d2").join(grouped, ["d1", "d2", "n"], "left")
    return out.select("id", "t", "n", F.col("kept.id").alias("component"), F.col("kept.t").alias("first"))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_shingles, component_id, kept`` of every row.

    Words end at blanks and control characters 9 to 13, A-Z count as a-z; a set
    holds the runs of ``size`` words, or the whole text if it has fewer. Texts are
    linked if their sets' similarity is ``percent`` in a hundred or more; null and
    empty texts are linked with nothing. Rows with a null id keep it; one that
    belongs to a group with ids gets the smallest of them. Repeated rows each get
    theirs; of different texts of a group with its smallest id one is kept. Other
    columns are left out. An empty table gives no rows.
    """
    out = _grouped(docs, size, percent, id_col, text_col)
    first = (F.col("id") == F.coalesce("component", "id")) & (F.col("t") == F.coalesce("first", "t"))
    kept = F.coalesce(first, F.lit(False)).alias("kept")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"), kept)


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group, unchanged: of those with the smallest id (an id goes before none) and one text, the least by hash.

    Rows that repeat with their text are a group, with an id or without; another
    text with the id of a copy stays. Null and empty texts are in no group and
    stay. Rows of one id and text with different other columns are chosen from by a
    hash of these. An empty table gives no rows.
    """
    keeps = F.col("id").eqNullSafe(F.col("component")) & (F.col("t") == F.col("first"))
    fate = _grouped(docs, size, percent, "doc_id", "text").where("first IS NOT NULL")
    fate = fate.groupBy(F.col("id").alias("fate_id"), F.col("t").alias("fate_text")).agg(F.max(keeps).alias("fate_kept"), F.count("*").alias("fate_rows"))
    # Texts of which no row stays as it is read, or one of several.
    fate = materialize(fate.where("NOT fate_kept OR fate_rows > 1"), "fate")
    rows = docs.select(F.struct("*").alias("row"))
    same = F.col("row.doc_id").cast("long").eqNullSafe(F.col("fate_id")) & (F.xxhash64("row.text") == F.col("fate_text"))
    out = rows.join(fate, same, "left_anti")
    again = fate.where("fate_kept")
    if not again.isEmpty():
        one = rows.join(again, same).groupBy("fate_id", "fate_text").agg(F.min_by("row", F.xxhash64(F.to_json("row"))).alias("row"))
        out = out.union(one.select("row"))
    return out.select("row.*")


def op4_near_duplicates(spark, sf_dir: str) -> DataFrame:
    """Groups of all documents by shingles of four words."""
    return near_duplicates(table(spark, sf_dir, "documents"), size=4)
