"""Personal data: fixed patterns and a semi-Markov conditional random field.

Method: pattern findings and generated examples label token segments. Around
every digit and @ the field chooses, by dynamic programming over entities of up
to 15 tokens, boundaries and types jointly, from features of whole segments.
Entities it finds with the wanted probability that touch no pattern finding are
added.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotflow.llm import semicrf
from lotflow.llm.common import append, map_arrow, table, texts
from lotflow.llm.secrets import SPANS, count_kind, span_text

# The parts of the base patterns.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_ACTIVE = re.compile(r"[0-9@]+")
#: Characters between active places that still form one region, and taken on either side of one.
REACH = 28
#: Tokens of a region that are decided together, which bounds the memory of a task, and those at either end of
#: them that are only context: the neighbouring block decides these.
BLOCK, CONTEXT = 512, 4 * semicrf.LONGEST
ADDED = "crf_"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of the pattern findings, in order.

    Each pattern is matched in linear time with the result of a leftmost scan: an
    address is sought from its @, numbers begin where digits begin.
    """
    found = []
    at, after = text.find("@"), 0
    while at >= 0:
        local = text[after:at]
        start = after + len(local.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, 0, domain.end()))
            after = domain.end()
        at = text.find("@", max(after, at + 1))
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and semicrf.luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append((m.start(), 3, m.end()))
    return sorted(found)


def regions(text: str) -> list[tuple[int, int]]:
    """Parts of lines around digits and @, cut at blanks."""
    out: list[list[int]] = []
    for m in _ACTIVE.finditer(text):
        a, b = m.span()
        if out and a - out[-1][1] <= 2 * REACH and "\n" not in text[out[-1][1] : a]:
            out[-1][1] = b
        else:
            out.append([a, b])
    wide = []
    for a, b in out:
        low = max(a - REACH, text.rfind("\n", 0, a) + 1)
        line = text.find("\n", b)
        high = min(b + REACH, line if line >= 0 else len(text))
        if low < a and low > 0:
            blank = text.find(" ", low, a)
            low = blank + 1 if blank >= 0 else low
        if high > b and high < len(text):
            blank = text.rfind(" ", b, high)
            high = blank if blank >= 0 else high
        wide.append((low, high))
    return wide


def _example(text: str, spans: list[tuple[int, int, int]]) -> tuple | None:
    """A training example; None if a span does not follow the tokens."""
    cut = semicrf.tokens(text)
    if not cut or len(cut) > BLOCK:
        return None
    begins, ends = {a: i for i, (a, _) in enumerate(cut)}, {b: i + 1 for i, (_, b) in enumerate(cut)}
    first, end, features = semicrf.segments(text, cut)
    number = {(int(a), int(b)): i for i, (a, b) in enumerate(zip(first, end))}
    truth, i = [], 0
    marked = {begins[a]: (ends[b], k + 1) for a, k, b in spans if a in begins and b in ends}
    if len(marked) < len(spans):
        return None
    while i < len(cut):
        j, y = marked.get(i, (i + 1, 0))
        if (i, j) not in number:
            return None
        truth.append((number[i, j], y))
        i = j
    return len(cut), first, end, features, truth


def _single(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans without those that begin within another."""
    out: list[tuple[int, int, int]] = []
    for s in spans:
        if not out or s[0] >= out[-1][2]:
            out.append(s)
    return out


def _labelled(docs: DataFrame, text_col: str) -> DataFrame:
    def make():
        def step(batch):
            out: dict[str, list] = {"part": [], "marked": []}
            for text in texts(batch):
                around = regions(text)
                spans = base_spans(text) if around else []
                for a, b in around:
                    own = [s for s in spans if a <= s[0] and s[2] <= b]
                    if b - a <= 400:
                        out["part"].append(text[a:b])
                        out["marked"].append(int(bool(own)))
            return out

        return step

    return map_arrow(docs.select(F.col(text_col).alias("text")), "part string, marked int", make).distinct()


def _generated(count: int, seed: int = 21) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """Examples of further forms of the four kinds and of numbers that are none."""
    rng = np.random.Generator(np.random.PCG64(seed))
    num = lambda n: "".join(map(str, rng.integers(0, 10, n)))
    words = ["call", "at", "on", "from", "the", "see", "write", "to", "order", "page", "about", "in", "mail", "phone", "server", "card"]
    word = lambda: words[int(rng.integers(0, len(words)))]

    def card() -> str:
        body = num(15)
        check = next(str(d) for d in range(10) if semicrf.luhn(body + str(d)))
        digits = body + check
        return ["-", " ", ""][int(rng.integers(0, 3))].join(digits[i : i + 4] for i in range(0, 16, 4))

    true = [
        lambda: (f"({num(3)}) 555-{num(4)}", 3), lambda: (f"{num(3)}-555-{num(4)}", 3), lambda: (f"+{num(2)} {num(3)} {num(7)}", 3),
        lambda: (f"{word()}{num(2)}@{word()}{num(1)}.example.com", 0), lambda: (f"{word()}.{word()} [at] {word()}{num(1)}.example.org", 0),
        lambda: (".".join(str(x) for x in rng.integers(0, 256, 4)), 1), lambda: (card(), 2),
    ]
    false = [
        lambda: f"{num(4)}-{num(2)}-{num(2)}", lambda: f"{num(2)}:{num(2)}", lambda: f"{num(1)}.{num(1)}.{num(2)}", lambda: f"{num(3)},{num(3)}.{num(2)}",
        lambda: num(int(rng.integers(1, 13))), lambda: "9" + num(15), lambda: f"v{num(1)}.{num(2)}", lambda: f"@{word()}", lambda: f"{num(2)}-{num(2)}",
    ]
    out = []
    for _ in range(count):
        text, spans = "", []
        for _ in range(int(rng.integers(1, 3))):
            text += " ".join(word() for _ in range(int(rng.integers(1, 4)))) + " "
            if rng.random() < 0.5:
                value, kind = true[int(rng.integers(0, len(true)))]()
                spans.append((len(text), kind, len(text) + len(value)))
            else:
                value = false[int(rng.integers(0, len(false)))]()
                if value[0] == "9" and semicrf.luhn(value):
                    value = num(5)
            text += value + " "
        out.append((text + word() + ".", spans))
    return out


def fit(docs: DataFrame, text_col: str = "text", sample: int = 300) -> dict:
    """A model trained on at most ``sample`` regions with and without findings (those with the smallest hashes
    among all distinct ones of up to 400 characters) and as many generated examples. An empty table leaves these."""
    found = _labelled(docs, text_col)
    parts = []
    for marked in (0, 1):
        parts += [r[0] for r in found.where(F.col("marked") == marked).orderBy(F.xxhash64("part"), "part").limit(sample).collect()]
    examples = [_example(p, _single(base_spans(p))) for p in parts]
    examples += [_example(t, s) for t, s in _generated(2 * sample)]
    return semicrf.train([e for e in examples if e])


def model_spans(text: str, model: dict, base: list[tuple[int, int, int]], least: float) -> list[tuple[int, int, int, float]]:
    """Entities of the model that touch no pattern finding, with their probability."""
    out = []
    for low, high in regions(text):
        part = text[low:high]
        every = semicrf.tokens(part)
        after = 0
        for at in range(0, max(1, len(every) - 2 * CONTEXT), BLOCK - 2 * CONTEXT):
            cut = every[at : at + BLOCK]
            # An entity belongs to the block that has it away from its ends.
            begin = CONTEXT if at else 0
            stop = len(cut) if at + BLOCK >= len(every) else BLOCK - CONTEXT
            first, end, features = semicrf.segments(part, cut)
            lattice = semicrf.Lattice(model, len(cut), first, end, features)
            entities = lattice.decode()
            if entities:
                probability = lattice.marginals()
                for s, y in entities:
                    if not begin <= first[s] < stop or at + first[s] < after:
                        continue
                    after = at + end[s]
                    a, b = low + cut[first[s]][0], low + cut[end[s] - 1][1]
                    p = float(probability[s, y])
                    if p >= least and not any(x < b and a < z for x, _, z in base):
                        out.append((a, y - 1, b, p))
    return out


def scan(docs: DataFrame, model: dict, least: float = 0.95, text_col: str = "text") -> DataFrame:
    """``row`` (all columns of ``docs``) and ``out.spans``: kind, start, end (code points) and probability.

    Ordered by start, kinds as listed, added ones (``crf_`` before their kind) last.
    Null and empty texts have no spans; repeated rows keep their own; an empty
    table gives no rows. The model sees regions of whole lines around digits and @
    in overlapping blocks of 512 tokens; patterns see the whole text.
    """

    def make():
        names = (*KINDS, *(ADDED + k for k in KINDS))

        def step(batch):
            spans = []
            for text in texts(batch, text_col):
                base = base_spans(text)
                found = [(a, k, b, 1.0) for a, k, b in base]
                found += [(a, k + len(KINDS), b, p) for a, k, b, p in model_spans(text, model, base, least)]
                spans.append([{"kind": names[k], "start": a, "end": b, "score": p} for a, k, b, p in sorted(found)])
            return {"spans": spans}

        return step

    return append(docs, SPANS, make)


def op9_pii(spark, sf_dir: str) -> DataFrame:
    """Personal data in all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    spans = F.col("out.spans")
    base = F.filter(spans, lambda s: ~s["kind"].startswith(ADDED))
    counts = [count_kind(spans, k).alias(f"n_{k}") for k in KINDS]
    return scan(docs, fit(docs)).select("row.doc_id", *counts, F.sha2(span_text(base), 256).alias("base_sha256"), span_text(spans).alias("spans"))
