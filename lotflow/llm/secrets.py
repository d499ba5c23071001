"""Secret scan: fixed patterns and a character network over all other candidates.

Method: findings of the patterns and generated ones label candidates (runs of 16
or more key characters that hold a digit). A character convolutional network
reads each candidate with 32 characters before and 16 after it. Its logits are
calibrated on a part kept from training, and the threshold is the highest level that
still finds the wanted share of that part's findings. All candidates of the corpus take part. Candidates above it that
touch no pattern finding are added.
"""

from __future__ import annotations

import re
import string
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotflow.llm import charnet
from lotflow.llm.common import append, map_arrow, table, texts
from lotflow.session import local_table, materialize

# The patterns of the base findings and their least lengths.
ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_VALUE, LEAST_ACCESS = 6, 20
KINDS = ("assign", "access", "hex")
ADDED = "model"

CANDIDATE = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
_DIGIT = re.compile(r"[0-9]")
#: Generated rows that do not depend on the corpus.
PLAIN = 3000
#: Passes over all examples, examples of a slice, and slices whose weights the driver averages; beyond that slices grow.
EPOCHS, SLICE, MOST_SLICES = 12, 4096, 256
#: Levels of a logit, and the logit beyond which there are no more.
LEVELS, TOP = 64, 64
SPANS = "spans array<struct<kind:string,start:bigint,end:bigint,score:double>>"


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """``(start, kind, end)`` of the pattern findings, by start and kind as listed."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_VALUE]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return [(a, KINDS[k], b) for a, k, b in sorted(found)]


def candidates(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in CANDIDATE.finditer(text) if _DIGIT.search(m[0])]


def _touches(start: int, end: int, spans: list[tuple[int, str, int]]) -> bool:
    return any(a < end and start < b for a, _, b in spans)


def _findings(docs: DataFrame, text_col: str) -> DataFrame:
    """All candidates of all documents as ``window, label``: whether a pattern finding touches it."""

    def make():
        def step(batch):
            out: dict[str, list] = {"window": [], "label": []}
            for text in texts(batch):
                found = candidates(text)
                spans = base_spans(text) if found else []
                for a, b in found:
                    out["window"].append(charnet.windows(text, a, b)[0])
                    out["label"].append(int(_touches(a, b, spans)))
            return out

        return step

    return map_arrow(docs.select(F.col(text_col).alias("text")), "window string, label int", make)


def _generated(contexts: list[str], count: int, seed: int = 11) -> tuple[list[str], list[int]]:
    """Labelled windows made from corpus contexts: keys in common forms, and long strings that are none."""
    rng = np.random.Generator(np.random.PCG64(seed))
    pick = lambda chars, n: "".join(np.array(list(chars))[rng.integers(0, len(chars), n)])
    mixed, low = string.ascii_letters + string.digits, "0123456789abcdef"
    names = ["pwd", "auth", "credential", "private_key", "access_key", "client_secret", "bearer", "api-key", "key", "session"]
    filler = contexts or ["the value of it was given in the text before"]
    windows, labels = [], []
    for i in range(count):
        context = filler[int(rng.integers(0, len(filler)))].replace("\0", "") or " "
        cut = int(rng.integers(0, len(context)))
        left, right = context[:cut] + " ", " " + context[cut:]
        secret = i % 2 == 0
        if secret:
            value = [lambda: pick(mixed, rng.integers(20, 48)) + "0", lambda: "ghp_" + pick(mixed, 36), lambda: "sk_live_" + pick(mixed, 24) + "7", lambda: pick(mixed + "+/", 40) + "1=", lambda: "eyJ" + pick(mixed + "_-", 40) + "." + pick(mixed, 20) + "3", lambda: pick(string.ascii_uppercase + string.digits, 24) + "5"][int(rng.integers(0, 6))]()
            if rng.random() < 0.7:
                left += names[int(rng.integers(0, len(names)))] + [" = ", ": ", '="', " "][int(rng.integers(0, 4))]
        else:
            words = context.split() or ["word"]
            word = lambda: "".join(c for c in words[int(rng.integers(0, len(words)))] if c.isascii() and c.isalpha()) or "page"
            value = [lambda: pick(string.digits, rng.integers(16, 24)), lambda: "/".join([word() for _ in range(4)]) + "/index2.html", lambda: f"{pick(string.digits, 4)}-{pick(string.digits, 2)}-{pick(string.digits, 2)}T00.00.00", lambda: "-".join(pick(low, n) for n in (8, 4, 4, 4, 12)), lambda: "_".join(word() for _ in range(4)) + "1", lambda: ".".join(pick(string.digits, 3) for _ in range(5))][int(rng.integers(0, 6))]()
            value = value.ljust(16, "0")
        text = left + value + right
        windows.append(charnet.windows(text, len(left), len(left) + len(value))[0])
        labels.append(int(secret))
    return windows, labels


def _examples(docs: DataFrame, text_col: str) -> DataFrame:
    """``window, label`` of all different candidates of the corpus, one generated for each of them from its context, and the plain generated ones."""

    def make():
        def step(batch):
            out: dict[str, list] = {"window": [], "label": []}
            for window, label in zip(batch.column("window").to_pylist(), batch.column("label").to_pylist()):
                seed = zlib.crc32(window.encode("utf-8", "surrogatepass"))
                made, labels = _generated([window[: charnet.BEFORE]], 2, seed)
                out["window"] += [window, made[seed & 1]]
                out["label"] += [label, labels[seed & 1]]
            return out

        return step

    plain = local_table(docs.sparkSession, list(zip(*_generated([], PLAIN))), "window string, label int")
    return map_arrow(_findings(docs, text_col).distinct(), "window string, label int", make).unionByName(plain)


def _passed(examples: DataFrame, state: list[dict], share: float, turn: int) -> list[dict]:
    """The state after a pass over all examples: every slice goes on from ``state``, and their results are averaged."""

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("window", "ascending"), ("label", "ascending")])
        y = rows["label"].to_numpy().astype(np.float64)
        after = charnet.epoch(state, charnet.codes(rows["window"].to_pylist()), y, share, turn)
        return pa.table({"slice": rows["slice"][:1], "n": [len(y)], "state": pa.array([charnet.flat(after)], pa.list_(pa.float64()))})

    parts = examples.groupBy("slice").applyInArrow(run, "slice long, n long, state array<double>").collect()
    parts.sort(key=lambda r: r["slice"])  # sums of floats depend on their order
    return charnet.shaped(np.average([r["state"] for r in parts], axis=0, weights=[r["n"] for r in parts]))


def _levels(kept: DataFrame, weights: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How many examples of each label have a logit of each level, ``1 / LEVELS`` wide."""

    def make():
        def step(batch):
            logit = charnet.logits(weights, charnet.codes(batch.column("window").to_pylist()))
            level = np.floor(np.clip(logit, -TOP, TOP) * LEVELS).astype(np.int64)
            return {"level": level, "label": batch.column("label")}

        return step

    counted = map_arrow(kept.select("window", "label"), "level long, label int", make).groupBy("level", "label").count()
    rows = np.array(sorted(tuple(r) for r in counted.collect()), dtype=np.int64).reshape(-1, 3)
    return rows[:, 0], rows[:, 1].astype(np.float64), rows[:, 2]


def _probability(model: dict, logit: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(model["slope"] * logit + model["shift"], -30, 30)))


def fit(docs: DataFrame, text_col: str = "text", recall: float = 0.98) -> dict:
    """The network's weights, its calibration and its threshold, from all candidates of all documents.

    A pass goes over slices of some ``SLICE`` examples in parallel and averages
    the weights; a table with one slice is trained as one. A fifth of the
    examples is kept from training for calibration and threshold, which come from
    counts of all kept ones by logit: the threshold is the lowest probability of
    a level, so that at least the ``recall`` is found. A table without candidates
    leaves the generated ones.
    """
    key = F.xxhash64("window")
    examples = _examples(docs, text_col).withColumn("kept", F.pmod(key, F.lit(5)) == 0)
    examples = materialize(examples.withColumn("hash", F.xxhash64(F.lit(3), "window")), "examples")
    trained = examples.where(~F.col("kept"))
    n, positive = trained.agg(F.count(F.lit(1)), F.sum("label")).first()
    slices = min(max(1, n // SLICE), MOST_SLICES)
    trained = trained.select("window", "label", F.pmod("hash", F.lit(slices)).cast("long").alias("slice"))
    state = charnet.start_state()
    for turn in range(EPOCHS):
        state = _passed(trained, state, positive / n, turn)
    level, y, count = _levels(examples.where("kept"), state[0])
    a, b = charnet.calibrate((level + 0.5) / LEVELS, y, count)
    model = {"weights": state[0], "slope": a, "shift": b}
    ends = np.stack([np.where(level <= -TOP * LEVELS, -1e9, level / LEVELS), np.where(level >= TOP * LEVELS, 1e9, (level + 1) / LEVELS)])
    least = _probability(model, ends).min(axis=0)[y > 0]
    order = np.argsort(least)
    missed = np.cumsum(count[y > 0][order])
    return {**model, "threshold": float(least[order][np.searchsorted(missed, int((1 - recall) * missed[-1]), side="right")])}


def scan(docs: DataFrame, model: dict, text_col: str = "text") -> DataFrame:
    """``row`` (all columns of ``docs``) and ``out.spans``: kind, start, end (code points) and probability, by start and kind.

    Pattern findings have probability 1. Null and empty texts have no spans;
    repeated rows keep their own; an empty table gives no rows.
    """

    def make():
        def step(batch):
            spans, pending, windows = [], [], []
            for text in texts(batch, text_col):
                base = base_spans(text)
                spans.append([(a, KINDS.index(k), b, 1.0) for a, k, b in base])
                for a, b in candidates(text):
                    if not _touches(a, b, base):
                        cut = charnet.windows(text, a, b)
                        pending.append((len(spans) - 1, a, b, len(windows), len(windows) + len(cut)))
                        windows += cut
            if pending:
                logit = charnet.logits(model["weights"], charnet.codes(windows))
                p = _probability(model, logit)
                for row, a, b, first, last in pending:
                    score = float(p[first:last].max())
                    if score >= model["threshold"]:
                        spans[row].append((a, len(KINDS), b, score))
            names = (*KINDS, ADDED)
            return {"spans": [[{"kind": names[k], "start": a, "end": b, "score": p} for a, k, b, p in sorted(s)] for s in spans]}

        return step

    return append(docs, SPANS, make)


def span_text(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def redact(docs: DataFrame, model: dict | None = None) -> DataFrame:
    """The documents with every found span replaced by ``<kind>``; the others unchanged. ``n_chars`` follows the text.

    Null and empty texts stay as they are, as do all other columns, whatever their
    names; repeated rows each stay. An empty table gives no rows.
    """
    found = scan(docs, model or fit(docs))
    # Spans that touch are replaced as one, by the kind of the first.
    merge = """aggregate(out.spans, named_struct('at', 0L, 'text', ''),
        (s, x) -> if(x.start < s.at, named_struct('at', greatest(s.at, x.end), 'text', s.text),
            named_struct('at', x.end, 'text', concat(s.text, substring(row.text, cast(s.at + 1 AS int), cast(x.start - s.at AS int)), '<', x.kind, '>'))),
        s -> concat(s.text, substring(row.text, cast(s.at + 1 AS int), 2147483647)))"""
    text = F.when(F.size("out.spans") == 0, F.col("row.text")).otherwise(F.expr(merge))
    columns = {"text": text}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(F.size("out.spans") == 0, F.col("row.n_chars")).otherwise(F.length(text).cast("long"))
    given = [columns.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns]
    return found.select(*given)


def op1_secrets(spark, sf_dir: str) -> DataFrame:
    """Secrets in all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    spans = F.col("out.spans")
    base = F.filter(spans, lambda s: s["kind"] != ADDED)
    counts = [count_kind(spans, k).alias(f"n_{k}") for k in KINDS]
    return scan(docs, fit(docs)).select("row.doc_id", *counts, F.sha2(span_text(base), 256).alias("base_sha256"), span_text(spans).alias("spans"))
