"""Main text of web pages by template deduction over the pages of a host.

Method: an element's token is the path of names down to it. Tokens with the same
occurrence vector over the pages of a host form an equivalence class; classes of
two tokens or more that half the pages have are valid. Nested by their paths they
are the template of the host. Its elements that occur once a page delimit slots;
the slot that holds the running text is chosen, slots whose text is the same on
nearly all pages are template text, and what the other slots inside the chosen
one hold is extracted. Hosts of fewer than three pages, and pages that lack the
slot, are their own template.

Vectors are summed as hashes, so that a host of any size is only ever a partial
aggregate.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotflow.llm.common import map_arrow, table, texts
from lotflow.llm.markup import Block, read
from lotflow.session import materialize

#: Pages of a host from which its template is deduced.
LEAST_PAGES = 3
#: Share of the text that the chosen slot holds.
SHARE = 0.8
#: Bytes of templates that are sent to every task; more are joined by shuffles.
BROADCAST_BYTES = 16_000_000
#: Elements that are part of a text, never the slot of one.
_PART = re.compile(r"(?:p|h[1-6]|li|ul|ol|dl|dt|dd|blockquote|pre|figure|figcaption)(?:\.|$)")
TEMPLATE = "host string, container string, fixed array<string>"


def host(url: str | None) -> str:
    """The host of an address in lower case; empty if there is none."""
    found = re.match(r"\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#\s]*)", url or "")
    return found[1].rpartition("@")[2].lower() if found else ""


def choose(single: dict[str, int], chars: dict[str, int]) -> str:
    """The slot of the running text among elements that occur once a page; ``chars`` by path of the blocks."""
    held = Counter({p: 0 for p in single})
    for path, n in chars.items():
        while path:
            held[path] += n
            path = path.rpartition("/")[0]
    for tag in ("article", "main"):
        named = [p for p in single if re.match(rf"{tag}\b", p.rpartition("/")[2])]
        if named:
            return max(named, key=lambda p: (held[p], -single[p]))
    total = sum(chars.values())
    wide = [p for p in single if total and held[p] >= SHARE * total and not _PART.match(p.rpartition("/")[2])]
    return max(wide, key=lambda p: (p.count("/"), held[p]), default="")


def page_tokens(html: str):
    """Count, first place, number and text digest of the blocks of every path of a page."""
    count, first, chars, text = Counter(), {}, Counter(), defaultdict(xxhash.xxh3_64)
    for place, item in enumerate(read(html)):
        if isinstance(item, Block):
            if not item.outside:
                chars[item.path] += len(item.text)
                text[item.path].update(item.text + "\n")
        elif not item.outside:
            count[item.path] += 1
            first.setdefault(item.path, place)
    return count, first, chars, text


def _tokens(pages: DataFrame) -> DataFrame:
    def make():
        def step(batch):
            out: dict[str, list] = {k: [] for k in ("host", "page", "path", "n", "first", "chars", "digest")}
            for k, (url, html) in enumerate(zip(batch.column("url").to_pylist(), texts(batch, "html"))):
                count, first, chars, text = page_tokens(html)
                page = xxhash.xxh3_64_intdigest(html) >> 1
                rows = [("", 1, 0, 0, 0)]
                rows += [(p, n, first[p], chars[p], text[p].intdigest() >> 1 if p in text else 0) for p, n in count.items()]
                for row in rows:
                    for name, value in zip(out, (host(url), page, *row)):
                        out[name].append(value)
            return out

        return step

    return map_arrow(pages, "host string, page bigint, path string, n int, first int, chars bigint, digest bigint", make)


def templates(pages: DataFrame) -> DataFrame:
    """Slot of the running text and paths of template text of every host with enough different pages."""
    # Copies of a page say nothing about what varies.
    tokens = _tokens(pages).groupBy("host", "page", "path").agg(F.max("n").alias("n"), F.min("first").alias("first"), F.max("chars").alias("chars"), F.max("digest").alias("digest"))
    texts_of = tokens.groupBy("host", "path", "digest").agg(
        F.count("*").alias("pages"), F.sum("n").alias("n"), F.sum("first").alias("first"), F.sum("chars").alias("chars"),
        F.sum(F.pmod(F.xxhash64("page", "n"), F.lit(1 << 31))).alias("vector"),
    )
    paths = texts_of.groupBy("host", "path").agg(
        F.sum("pages").alias("pages"), F.sum("n").alias("n"), (F.sum("first") / F.sum("pages")).alias("first"), F.sum("chars").alias("chars"),
        F.sum("vector").alias("vector"), F.max("pages").alias("alike"),
    )
    paths = materialize(paths, "paths")
    sizes = paths.where("path = ''").select("host", F.col("pages").alias("of")).where(F.col("of") >= LEAST_PAGES)
    # At most twice the paths of an average page are on half of a host's pages.
    frequent = paths.where("path <> ''").join(sizes, "host").where("2 * pages >= of")
    classes = frequent.groupBy("host", "of", "vector", "pages", "n").agg(F.sort_array(F.collect_list(F.struct("first", "path", "chars", "alike"))).alias("tokens"))
    hosts = classes.groupBy("host", "of").agg(F.collect_list(F.struct("pages", "n", "tokens")).alias("classes"))

    def make():
        def step(batch):
            out: dict[str, list] = {"host": [], "container": [], "fixed": []}
            for name, of, found in zip(*(batch.column(k).to_pylist() for k in ("host", "of", "classes"))):
                single, chars, fixed = {}, {}, []
                for c in found:
                    once = c["n"] == c["pages"] and (len(c["tokens"]) >= 2 or c["pages"] == of)
                    for t in c["tokens"]:
                        if t["alike"] >= 0.9 * c["pages"] and t["chars"]:
                            fixed.append(t["path"])
                            continue
                        chars[t["path"]] = t["chars"]
                        if once:
                            single[t["path"]] = int(t["first"])
                slot = choose(single, chars)
                # An article is no template text, however alike a host's pages are.
                inner = [p for p in fixed if not slot or p.startswith(slot + "/")]
                semantic = re.match(r"(article|main)\b", slot.rpartition("/")[2])
                out["host"].append(name)
                out["container"].append(slot)
                out["fixed"].append([] if semantic else sorted(inner))
            return out

        return step

    return map_arrow(hosts, TEMPLATE, make)


def extract(html: str, container: str | None, fixed: list[str]) -> str:
    """The blocks of the slot, one a line; of the page's own slot if it lacks the host's."""
    items = list(read(html))
    starts = Counter(i.path for i in items if not isinstance(i, Block))
    if not container or starts[container] != 1:
        chars: Counter = Counter()
        for i in items:
            if isinstance(i, Block) and not i.outside:
                chars[i.path] += len(i.text)
        container = choose({p: k for k, (p, n) in enumerate(starts.items()) if n == 1}, chars)
        fixed = []
    below = container + "/"
    blocks = [i.text for i in items if isinstance(i, Block) and not i.outside and (i.path == container or i.path.startswith(below)) and i.path not in fixed]
    return "\n".join(blocks)


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id, url, text, n_chars`` of every page.

    Null html counts as empty and has empty text. Pages without a host share the
    empty one. Repeated pages each get a row, but count once in a template. Other
    columns are left out. An empty table gives no rows.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))
    found = materialize(templates(rows.select("url", "html")), "templates")
    size = found.select(F.sum(F.length("host") + F.length("container") + F.length(F.array_join("fixed", ",")) + 48)).first()[0] or 0
    name = F.lower(F.regexp_extract("url", r"^\s*(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#\s]*@)?([^/?#\s@]*)", 1))
    keyed = rows.withColumn("host", F.coalesce(name, F.lit("")))
    joined = keyed.join(F.broadcast(found) if size <= BROADCAST_BYTES else found, "host", "left")

    def make():
        def step(batch):
            html = texts(batch, "html")
            out = [extract(h, c, f or []) for h, c, f in zip(html, batch.column("container").to_pylist(), batch.column("fixed").to_pylist())]
            return {"id": batch.column("id"), "url": batch.column("url"), "text": out, "n_chars": list(map(len, out))}

        return step

    kind = rows.schema["id"].dataType.simpleString()
    texts_found = map_arrow(joined.select("id", "url", "html", "container", "fixed"), f"id {kind}, url string, text string, n_chars bigint", make)
    return texts_found.withColumnRenamed("id", id_col).withColumnRenamed("url", url_col)


def op5_html_text(spark, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return main_text(table(spark, sf_dir, "pages"))
