"""Main text of web pages by deducing the template of each host.

1. Every page gives its tokens: the elements it opens, named by their path, and its blocks of text at their path. A token's
   occurrence vector says how often each page of the host has it. Tokens with equal vectors form an equivalence class;
   vectors are compared by sums of hashes over the pages, so only one row per token and host is ever aggregated.
2. A class is valid if enough different pages have it and all of them have its tokens in one order. Text inside an article counts
   by the different texts next to it, so that copies of an article, exact or near, are no template. Valid classes that cross
   no larger one on any page nest into the template of the host. Elements that the templates of many hosts share make up a common
   template, which hosts with few pages get as well.
3. The template's elements cut each page into slots, and template text is dropped. What a slot is, its text says: an article
   or main element around most of it is evidence, and a slot of links is none. The slots of the strongest evidence that holds a fair part of
   the page's text are the article. Elements and roles that HTML keeps for menus, forms and the like drop their
   text; class names and ids do so only if the template has the element, or most of its text is links.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegrid.llm.batches import id_and_text, small_side, steps, with_id
from tidegrid.llm.markup import Block, parse
from tidegrid.session import stored

#: Different pages that must share a class, at least, and as a share of the host's different pages (of several layouts, perhaps);
#: the share of its pages that must have different texts beside a text of an article.
MIN_PAGES, MIN_SHARE, MIN_BESIDE = 4, 0.25, 0.5
#: Share of all hosts whose templates must have an element for the common template.
MIN_HOSTS = 0.25
#: Above this share of link text a slot holds a menu.
MOST_LINKED = 0.5
#: Evidence counts if it holds this share of the text of the largest part of a page.
FAIR_PART = 1 / 3


def host_of(url: Column | str) -> Column:
    """Host of a URL without user, port and a leading ``www.``; empty if there is none."""
    url = F.col(url) if isinstance(url, str) else url
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?(?:www\.)?([^/?#:]*)", 1), F.lit(""))


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def _block_token(block: Block) -> int:
    return _hash(f"{block.path}\n{block.text}")


def page_tokens(page: str) -> dict[int, list]:
    """``[n, first, is_text, inside, before, after]`` by token of a page: how often it has each and where first, whether it is a
    text inside an article, and the texts beside that."""
    blocks, tags = parse(page)
    found: dict[int, list] = {}
    for path, order in tags:
        seen = found.setdefault(_hash(path), [0, order, False, False, 0, 0])
        seen[0] += 1
    tokens = [_block_token(b) for b in blocks]
    for i, (b, token) in enumerate(zip(blocks, tokens)):
        if b.article:
            before = tokens[i - 1] if i and blocks[i - 1].article else 0
            after = tokens[i + 1] if i + 1 < len(blocks) and blocks[i + 1].article else 0
        else:
            before = after = 0
        seen = found.setdefault(token, [0, b.order, True, b.article, before, after])
        seen[0] += 1
    return found


_TOKENS = ("host string, page bigint, token bigint, n bigint, first bigint, is_text boolean, inside boolean, before bigint, "
           "after bigint")


def _tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Tokens of the different pages of a task."""
    seen: set[int] = set()
    for rows in steps(batches):
        out = []
        for host, page in zip(rows["host"], rows["text"]):
            key = _hash(f"{host}\n{page}")
            if key not in seen:
                seen.add(key)
                out += [(host, key, token, *about) for token, about in page_tokens(page).items()]
        if out:
            yield pd.DataFrame(out, columns=[c.split()[0] for c in _TOKENS.split(", ")])


def templates(pages: DataFrame) -> DataFrame:
    """``(host, token, is_text, class_id, class_size)`` of the template of every host, from ``pages (host, text)``."""
    return _templates(page_table(pages))


def page_table(pages: DataFrame) -> DataFrame:
    """The tokens of every different page of a host, written out."""
    tokens = pages.select("host", "text").mapInPandas(_tokens, _TOKENS)
    # Copies of a page in other tasks are one page too: all their tokens are the same.
    names = [c for c in tokens.columns if c not in ("host", "page", "token")]
    return stored(tokens.groupBy("host", "page", "token").agg(*[F.min(c).alias(c) for c in names]))


def _frequent(tokens: DataFrame) -> DataFrame:
    """``(host, token, pages, host_pages, is_text, inside, v1, v2)`` of what enough pages of a host have; ``v1, v2`` are
    hashes of the occurrence vector."""
    n_pages = tokens.select("host", "page").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
    hashed = [F.sum(F.shiftright(F.xxhash64("page", "n", F.lit(k)), 32)).alias(f"v{k}") for k in (1, 2)]
    vectors = tokens.groupBy("host", "token").agg(
        F.count(F.lit(1)).alias("pages"), F.min("is_text").alias("is_text"), F.max("inside").alias("inside"), *hashed)
    return vectors.join(n_pages, "host").filter(F.col("pages") >= F.greatest(F.lit(MIN_PAGES), MIN_SHARE * F.col("host_pages")))


def _templates(tokens: DataFrame) -> DataFrame:
    frequent = stored(_frequent(tokens).withColumn("class_id", F.xxhash64("pages", "v1", "v2")))
    # Texts of articles that stand beside many different texts.
    inside = frequent.filter("inside").select("host", "token", "host_pages")
    beside = tokens.filter("inside").join(inside, ["host", "token"])
    sides = [beside.select("host", "token", "host_pages", F.lit(side).alias("side"), F.col(side).alias("text")).distinct()
             .groupBy("host", "token", "side").agg(F.count(F.lit(1)).alias("texts"), F.first("host_pages").alias("host_pages"))
             for side in ("before", "after")]
    repeated = (sides[0].unionByName(sides[1]).filter(
        F.col("texts") >= F.greatest(F.lit(MIN_PAGES), MIN_BESIDE * F.col("host_pages"))).select("host", "token").distinct())
    columns = ["host", "token", "class_id", "is_text"]
    frequent = small_side(frequent.filter("not inside").select(*columns).unionByName(
        frequent.filter("inside").join(repeated, ["host", "token"], "left_semi").select(*columns)))

    # Order: on every page that has the class, its tokens come in the same sequence.
    placed = tokens.select("host", "page", "token", "first").join(frequent, ["host", "token"])
    in_page = (placed.groupBy("host", "class_id", "page").agg(
        F.hash(F.transform(F.array_sort(F.collect_list(F.struct("first", "token"))), lambda x: x["token"])).alias("sequence"),
        F.count(F.lit(1)).alias("size")))
    classes = (in_page.groupBy("host", "class_id").agg(
        F.min("sequence").alias("low"), F.max("sequence").alias("high"), F.max("size").alias("class_size"))
        .filter("low = high").select("host", "class_id", "class_size"))
    valid = small_side(frequent.join(classes, ["host", "class_id"]))
    # Nesting: the different sequences of classes on the pages of a host are few.
    layouts = (placed.drop("is_text").join(valid.select("host", "class_id", "token"), ["host", "class_id", "token"])
               .groupBy("host", "page").agg(F.transform(F.array_sort(F.collect_list(F.struct("first", "class_id"))),
                                                        lambda x: x["class_id"]).alias("classes"))
               .select("host", "classes").distinct())
    # A class that crosses a larger one (of equal ones, that of lesser key) on any page goes, unless that one goes itself.
    sizes = valid.select("host", "class_id", "class_size").distinct().groupBy("host").agg(
        F.collect_list(F.struct("class_id", "class_size")).alias("sizes"))
    crossed = layouts.mapInPandas(_crossings, "host string, a bigint, b bigint").distinct().groupBy("host").agg(
        F.collect_list(F.struct("a", "b")).alias("pairs"))
    gone = sizes.join(crossed, "host").mapInPandas(_outdone, "host string, class_id bigint")
    return valid.join(gone, ["host", "class_id"], "left_anti").select("host", "token", "is_text", "class_id", "class_size")


def _crossings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The pairs of classes of a layout that overlap without one lying in a gap of the other."""
    for rows in batches:
        out = []
        for host, classes in zip(rows["host"], rows["classes"]):
            places: dict[int, list[int]] = {}
            for place, c in enumerate(classes.tolist()):
                places.setdefault(c, []).append(place)
            within = {c: set(classes[p[0]:p[-1] + 1].tolist()) for c, p in places.items()}
            out += [(host, a, b) for a, own in within.items() for b in own if a < b and a in within[b]]
        yield pd.DataFrame(out, columns=["host", "a", "b"])


def _outdone(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The classes that cross one that stays, larger ones first."""
    for rows in batches:
        out = []
        for host, sizes, pairs in zip(rows["host"], rows["sizes"], rows["pairs"]):
            crosses: dict[int, set[int]] = {}
            for pair in pairs:
                crosses.setdefault(pair["a"], set()).add(pair["b"])
                crosses.setdefault(pair["b"], set()).add(pair["a"])
            kept: set[int] = set()
            for _, c in sorted((-s["class_size"], s["class_id"]) for s in sizes):
                if kept.isdisjoint(crosses.get(c, ())):
                    kept.add(c)
                else:
                    out.append((host, c))
        yield pd.DataFrame(out, columns=["host", "class_id"])


def common_template(tokens: DataFrame) -> list[int]:
    """Elements that a quarter of all hosts, and ``MIN_PAGES`` at least, have on most of their pages: at most 8 times the mean
    number of elements of a page."""
    pages = tokens.groupBy("host").agg(F.countDistinct("page").alias("host_pages"))
    usual = (tokens.filter("not is_text").groupBy("host", "token").agg(F.count(F.lit(1)).alias("pages")).join(pages, "host")
             .filter(2 * F.col("pages") > F.col("host_pages")).groupBy("token").agg(F.count(F.lit(1)).alias("hosts")))
    n = pages.count()
    return [r["token"] for r in usual.filter(F.col("hosts") >= max(MIN_PAGES, MIN_HOSTS * n)).toLocalIterator()]


def main_text(page: str, template: frozenset[int]) -> str:
    """Blocks of the article of a page, one per line, given the tokens of its host's template."""
    blocks, tags = parse(page)
    marks = sorted(order for path, order in tags if _hash(path) in template)

    def wanted(b: Block) -> bool:
        if b.chrome or b.header and not (b.heading and (b.article or b.main)) or _block_token(b) in template:
            return False
        return not b.named or _hash(b.named) not in template and b.linked <= MOST_LINKED * len(b.text)

    slots: dict[int, list[Block]] = {}
    for b in filter(wanted, blocks):
        slots.setdefault(bisect.bisect(marks, b.order), []).append(b)
    parts: dict[int, list[list[Block]]] = {0: [], 1: [], 2: []}
    for slot in slots.values():
        sizes = [0, 0, 0]
        for b in slot:
            sizes[0 if b.article else 1 if b.main else 2] += len(b.text)
        if sum(b.linked for b in slot) <= MOST_LINKED * sum(sizes) or sizes[0]:
            parts[sizes.index(max(sizes))].append(slot)
    mass = [sum(len(b.text) for slot in part for b in slot) for part in parts.values()]
    chosen = next((k for k in range(3) if mass[k] and mass[k] >= FAIR_PART * max(mass)), 2)
    return "\n".join(b.text for slot in parts[chosen] for b in slot)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(id_col, url_col, text, n_chars)``, one row per page.

    The text is that of the slots of the host's template (and of the common one) that hold the article, see :func:`main_text`.
    A missing page counts as empty and has an empty text; pages without a URL are those of one nameless host. Missing and
    repeated ids, and repeated pages, are rows like others; other columns are not read.
    """
    rows = id_and_text(pages, id_col, html_col, url=F.col(url_col), host=host_of(url_col))
    tokens = page_table(rows)
    common = frozenset(common_template(tokens))
    own = _templates(tokens).groupBy("host").agg(F.collect_list("token").alias("template"))  # what many of its pages have

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[str, frozenset[int]] = {}
        for part in steps(batches):
            texts = []
            for host, template, page in zip(part["host"], part["template"], part["text"]):
                if host not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[host] = common.union(() if template is None else template.tolist())
                texts.append(main_text(page, known[host]))
            yield part[["id", "url"]].assign(text=texts, n_chars=[len(t) for t in texts])

    out = (rows.join(small_side(own), "host", "left")
           .mapInPandas(run, f"id string, url {pages.schema[url_col].dataType.simpleString()}, text string, n_chars bigint"))
    return with_id(out.withColumnRenamed("url", url_col), pages, id_col)
