"""Language identification by hyperdimensional profiles.

Method: every letter has a random vector of +1 and -1. The vector of a trigram
binds (multiplies) those of its letters, the first rotated by two places and the
second by one; a text bundles (adds) the vectors of its trigrams, a language
prototype those of all its training texts. A text gets the language whose
prototype has the largest cosine with its bundle.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotflow.llm.common import append, chunks, map_arrow, table, texts

DIMENSIONS, SYMBOLS = 1024, 128
UNKNOWN = "und"
#: Trigram vectors that a task remembers: 80 MB.
KEPT = 20_000


def _symbol(c: int) -> int:
    """0 for what is no letter, 1 to 26 for a-z in either case, one of 101 further symbols for other letters."""
    character = chr(c)
    if not character.isalpha():
        return 0
    low = ord(character.lower()[0])
    return low - 96 if 97 <= low <= 122 else 27 + low % 101


_tables: dict[str, np.ndarray] = {}


def _table() -> np.ndarray:
    if "symbols" not in _tables:
        _tables["symbols"] = np.fromiter(map(_symbol, range(0x110000)), np.uint8, 0x110000)
    return _tables["symbols"]


def trigrams(values: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all trigrams of the texts, and where each text's begin. Runs of other signs count as one blank, and blanks surround a text."""
    joined = "\0".join(values)
    points = np.frombuffer(("\0" + joined + "\0").encode("utf-32-le", "surrogatepass"), np.uint32)
    symbols = _table()[points]
    lengths = np.fromiter(map(len, values), np.int64, len(values))
    edge = np.zeros(len(symbols), bool)
    begins = np.cumsum(lengths + 1)
    edge[np.r_[0, begins]] = True
    keep = edge.copy()
    keep[1:] |= (symbols[1:] > 0) | (symbols[:-1] > 0)
    kept, edge = symbols[keep], edge[keep]
    # An edge stands for the blanks next to it.
    blank = (kept == 0) & ~edge
    keep = ~blank
    keep[1:-1] |= ~(edge[:-2] | edge[2:])
    kept, bounds = kept[keep].astype(np.uint32), np.flatnonzero(edge[keep])
    codes = (kept[:-2] << 14) | (kept[1:-1] << 7) | kept[2:]
    valid = np.ones(len(codes), bool)
    valid[bounds[1:-1] - 1] = False
    where = np.r_[0, np.cumsum(valid)]
    starts = where[np.minimum(bounds, len(codes))]
    return codes[valid], starts


class Vectors:
    """The random letter vectors and the trigram vectors made from them."""

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = 7):
        letters = np.random.Generator(np.random.PCG64(seed)).integers(0, 2, (SYMBOLS, dimensions), dtype=np.int8) * 2 - 1
        self.parts = np.roll(letters, 2, axis=1), np.roll(letters, 1, axis=1), letters

    def of(self, codes: np.ndarray) -> np.ndarray:
        first, second, third = self.parts
        return first[codes >> 14] * second[(codes >> 7) & 127] * third[codes & 127]

    def bundle(self, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        total = np.zeros(self.parts[0].shape[1])
        for at in range(0, len(codes), 4096):
            total += counts[at : at + 4096].astype(np.float64) @ self.of(codes[at : at + 4096])
        return total


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a document is kept from learning; a null id is not, but is not learned from either."""
    return F.coalesce(_part(id_col) == 2, F.lit(False))


def _part(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 4


def learn(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """Prototype of each language: all trigrams of all rows with text and language, counted and bundled in tasks.

    What reaches the driver is one number per language and dimension.
    """

    def count():
        def step(batch):
            out = {"lang": [], "code": [], "n": []}
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            values = texts(batch)
            for lang in sorted(set(langs)):
                own = [values[i] for i in np.flatnonzero(langs == lang)]
                total = np.zeros(SYMBOLS**3, np.int64)
                for part in chunks(own, len, 2_000_000):
                    total += np.bincount(trigrams(own[part])[0], minlength=SYMBOLS**3)
                codes = np.flatnonzero(total)
                out["lang"] += [lang] * len(codes)
                out["code"].append(codes)
                out["n"].append(total[codes])
            for name in ("code", "n"):
                out[name] = np.concatenate(out[name])
            return out

        return step

    def bundle():
        vectors = Vectors(dimensions)

        def step(batch):
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            codes, n = batch.column("code").to_numpy(), batch.column("n").to_numpy()
            names = sorted(set(langs))
            sums = [vectors.bundle(codes[langs == x], n[langs == x]) for x in names]
            return {"lang": names, "total": [s.astype(np.int64) for s in sums]}

        return step

    rows = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    counts = map_arrow(rows, "lang string, code int, n bigint", count).groupBy("lang", "code").agg(F.sum("n").alias("n"))
    sums = map_arrow(counts, "lang string, total array<bigint>", bundle).select("lang", F.posexplode("total").alias("d", "v"))
    found: dict[str, np.ndarray] = {}
    for lang, d, v in sums.groupBy("lang", "d").agg(F.sum("v")).collect():
        found.setdefault(lang, np.zeros(dimensions))[d] = v
    return found


def identify(docs: DataFrame, prototypes: dict[str, np.ndarray], text_col: str = "text") -> DataFrame:
    """``row`` (all columns of ``docs``) and ``out``: ``lang_pred`` and ``score``, the cosine cut at 0.

    Null texts and texts without a letter are ``und`` with score 0, as is every
    text if nothing was learned. Of equal cosines the first language in sorted
    order wins. Repeated rows keep their own results; an empty table gives no rows.
    """
    names = sorted(prototypes)
    matrix = np.array([prototypes[n] / max(np.linalg.norm(prototypes[n]), 1e-300) for n in names])
    dimensions = matrix.shape[1] if names else DIMENSIONS

    def make():
        vectors, rank = Vectors(dimensions), np.full(SYMBOLS**3, -1, np.int32)
        rows = np.empty((KEPT, dimensions), np.float32)
        used = 0

        def rows_of(codes: np.ndarray) -> np.ndarray:
            nonlocal used
            new = codes[rank[codes] < 0]
            if used + len(new) > KEPT:
                rank.fill(-1)
                used, new = 0, codes
            if len(new) > KEPT:
                return vectors.of(codes).astype(np.float32)
            rank[new] = np.arange(used, used + len(new))
            rows[used : used + len(new)] = vectors.of(new)
            used += len(new)
            return rows[rank[codes]]

        def step(batch):
            values = texts(batch, text_col)
            langs, scores = [], []
            for part in chunks(values, len, 500_000):
                codes, starts = trigrams(values[part])
                for value, a, b in zip(values[part], starts[:-1], starts[1:]):
                    own = np.sort(codes[a:b])
                    firsts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else own
                    if not names or not len(own) or own[-1] == 0:
                        langs.append(UNKNOWN)
                        scores.append(0.0)
                        continue
                    counts = np.diff(np.r_[firsts, len(own)]).astype(np.float32)
                    vector = counts @ rows_of(own[firsts])
                    cosines = matrix @ vector / max(float(np.linalg.norm(vector)), 1e-300)
                    best = int(np.argmax(cosines))
                    langs.append(names[best])
                    scores.append(min(1.0, max(0.0, float(cosines[best]))))
            return {"lang_pred": langs, "score": scores}

        return step

    return append(docs, "lang_pred string, score double", make)


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents with a language; those without text or letters go, and a missing ``lang`` becomes the predicted one."""
    prototypes = learn(docs.where(_part("doc_id") != 2))
    found = identify(docs, prototypes).where(F.col("out.lang_pred") != UNKNOWN)
    return found.select(F.col("row").withField("lang", F.coalesce("row.lang", "out.lang_pred")).alias("row")).select("row.*")


def op10_language_id(spark, sf_dir: str) -> DataFrame:
    """Predicted language of all documents, learned from three quarters of them."""
    docs = table(spark, sf_dir, "documents")
    prototypes = learn(docs.where(_part("doc_id") != 2))
    found = identify(docs.select("doc_id", "text"), prototypes)
    return found.select("row.doc_id", held_out("row.doc_id").alias("held_out"), "out.lang_pred", "out.score")
