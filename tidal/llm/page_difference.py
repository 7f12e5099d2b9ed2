"""Main text of web pages by nearest-URL page differencing.

Pages of a host are ordered by URL path; a page's partner is the neighbour
(previous or next) that shares the longer beginning of the path (ties: the
previous). The page's text lines, its blocks, are aligned with the partner's
by a longest common subsequence; lines that both share are template and are
deleted, and lines that the partner lacks stay. What the markup itself says is
kept beside it: lines in menus, headers, footers, sidebars, notices, adverts,
forms and comments go also when the partner lacks them, and inside an
``article`` (or ``main``) a shared line is template only if more than
``COMMON`` of the host's pages hold it too, since an article may quote its
neighbour. An article that is a copy of its partner's (shares more than
``COPIED`` of its text) stays whole.
A page without partner has only its markup: its article, or else all unmarked
lines, are main text.

Pairing sorts narrow rows (line hashes) by range, so a large host spreads over
many tasks; rows at the ends of a task's range are paired in a second step
over two rows a task.

Defined cases: null html is empty, its text the empty string; a null or
odd URL has the empty host; a page without neighbour has no partner; equal
rows get equal results; unclosed and stray tags are tolerated.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import quoted, stored, texts, with_computed

RAW = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|svg|iframe|object|math|title|textarea|select)\b[^>]*>"
                 r".*?(?:</\1\s*>|\Z)", re.I | re.S)
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?/][^>]*>")
CUT_TAG = re.compile(r"<[a-zA-Z/!?][^>]*\Z")
NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
HIDDEN = re.compile(r"\bhidden\b|display\s*:\s*none", re.I)
BLOCKS = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
             "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre "
             "section summary table tbody td tfoot th thead tr ul".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
ASIDE = set("nav footer aside form button dialog menu head".split())
MARKED = set("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
             "cookies disqus footer masthead menu modal nav navbar navigation newsletter notice notices pagination popup promo "
             "promoted related share sharing sidebar social sponsor sponsored subscribe toolbar widget complementary "
             "contentinfo".split())
SPACES = re.compile(r"\s+")
ASIDE_LINE, NEUTRAL, ARTICLE = 0, 1, 2
COMMON = 0.5
COPIED = 0.5


def lines_of(page: str) -> list[tuple[str, int]]:
    """The page's blocks in order with their zone."""
    out: list[tuple[str, int]] = []
    stack: list[tuple[str, int]] = []  # open elements and the zone inside each
    buffer: list[str] = []

    def flush(zone: int) -> None:
        text = SPACES.sub(" ", entities.unescape("".join(buffer))).strip()
        buffer.clear()
        if text:
            out.append((text, zone))

    def zone() -> int:
        return stack[-1][1] if stack else NEUTRAL

    page = RAW.sub(lambda m: "" if m[0].startswith("<!--") else " ", page)
    at = 0
    for m in TAG.finditer(page):
        buffer.append(page[at:m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if name == "br":
            buffer.append(" ")
            continue
        if name in BLOCKS:
            flush(zone())
        if m[1]:
            opened = [k for k, (t, _) in enumerate(stack) if t == name]
            if opened:
                del stack[opened[-1]:]
            continue
        if name in BLOCKS and stack and any(t == "p" for t, _ in stack):
            last = max(k for k, (t, _) in enumerate(stack) if t == "p")
            if not any(t in BLOCKS for t, _ in stack[last + 1:]):
                del stack[last:]  # a block ends an open paragraph
        if name in VOID or (m[3] or "").rstrip().endswith("/"):
            continue
        inside = zone()
        names = {w for v in NAMED.findall(m[3] or "") for w in re.split(r"[\s_-]+", "".join(v).lower())}
        if inside != ASIDE_LINE:
            if name in ASIDE or names & MARKED or (name == "header" and inside != ARTICLE) or HIDDEN.search(m[3] or ""):
                inside = ASIDE_LINE
            elif name in ("article", "main"):
                inside = ARTICLE
        stack.append((name, inside))
    buffer.append(CUT_TAG.sub("", page[at:]))
    flush(zone())
    return out


def line_hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "replace")) - (1 << 63)


def shared_lines(a: list[int], b: list[int]) -> set[int]:
    """Places in ``a`` of a longest common subsequence with ``b``."""
    places: dict[int, list[int]] = {}
    for j in range(len(b) - 1, -1, -1):
        places.setdefault(b[j], []).append(j)
    ends: list[int] = []
    nodes: list[tuple[int, int]] = []  # (place in a, earlier node)
    at: list[int] = []
    for i, x in enumerate(a):
        for j in places.get(x, ()):
            k = bisect_left(ends, j)
            nodes.append((i, at[k - 1] if k else -1))
            if k == len(ends):
                ends.append(j)
                at.append(len(nodes) - 1)
            else:
                ends[k], at[k] = j, len(nodes) - 1
    out, node = set(), at[-1] if at else -1
    while node >= 0:
        i, node = nodes[node]
        out.add(i)
    return out


def main_lines(lines: list[tuple[str, int]], partner: list[int], common: list[int]) -> list[str]:
    """The lines that differencing and the markup leave; ``common`` are the
    lines of most pages of the host."""
    if not partner:
        own = [t for t, z in lines if z == ARTICLE]
        return own or [t for t, z in lines if z == NEUTRAL]
    hashes, usual = [line_hash(t) for t, _ in lines], set(common)
    shared = shared_lines(hashes, partner)
    own = sum(len(t) for t, z in lines if z == ARTICLE)
    copied = sum(len(t) for i, (t, z) in enumerate(lines) if z == ARTICLE and i in shared) > COPIED * own
    return [t for i, (t, z) in enumerate(lines)
            if z != ASIDE_LINE and (i not in shared or (z == ARTICLE and (copied or hashes[i] not in usual)))]


def common_start(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


SORTED = ("k long, host string, path string, lines array<long>, part int, place long, last boolean, edge boolean, "
          "near array<long>, likeness int")


def common_lines(narrow: DataFrame) -> DataFrame:
    """(host, common): the lines that more than ``COMMON`` of a host's pages
    hold, of hosts with two pages or more. No host has more of them than
    its pages have lines on average, divided by ``COMMON``."""
    pages = narrow.groupBy("host").agg(F.count(F.lit(1)).alias("pages")).where("pages > 1")
    lines = narrow.select("host", F.explode(F.array_distinct("lines")).alias("line")).groupBy("host", "line").agg(F.count(F.lit(1)).alias("n"))
    return lines.join(pages, "host").where(F.col("n") > COMMON * F.col("pages")).groupBy("host").agg(F.collect_list("line").alias("common"))


def partners(keyed: DataFrame) -> DataFrame:
    """(k, near, common): the partner's lines and the host's common ones."""
    def hashes():
        def work(batch):
            return [pa.array([[line_hash(t) for t, _ in lines_of(h)] for h in texts(batch, "html")], pa.list_(pa.int64()))]
        return work

    narrow = stored(with_computed(keyed.select("k", "host", "path", "html"), "lines array<long>", hashes)
                    .drop("html").dropDuplicates(["k"]), "page-lines")
    parts = max(int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    ordered = narrow.repartitionByRange(parts, "host", "path", "k").sortWithinPartitions("host", "path", "k")
    schema = pa.schema([("k", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("lines", pa.list_(pa.int64())),
                        ("part", pa.int32()), ("place", pa.int64()), ("last", pa.bool_()), ("edge", pa.bool_()),
                        ("near", pa.list_(pa.int64())), ("likeness", pa.int32())])

    def pair(batches):
        part, place, before, now = TaskContext.get().partitionId(), 0, None, None

        def paired(r, prev, nxt, edge, last=False):
            best, near = -1, None
            for other in (prev, nxt):
                if other and other["host"] == r["host"] and common_start(r["path"], other["path"]) > best:
                    best, near = common_start(r["path"], other["path"]), other["lines"]
            return r | {"part": part, "place": place, "last": last, "edge": edge, "near": near, "likeness": best}

        for batch in batches:
            out = []
            for r in batch.to_pylist():
                if now is not None:
                    out.append(paired(now, before, r, before is None))
                    place += 1
                before, now = now, r
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
        if now is not None:
            yield pa.RecordBatch.from_pylist([paired(now, before, None, True, True)], schema)

    rows = stored(ordered.mapInArrow(pair, SORTED), "page-pairs")
    # the ends of the tasks' ranges, two rows each: the last row of a range and the first of the next one with rows
    ends = rows.where("edge")
    ranks = ends.select("part").distinct().withColumn("rank", F.row_number().over(Window.orderBy("part")))  # one number a task
    ends = ends.join(F.broadcast(ranks), "part")
    left = ends.where("last").select(F.col("rank").alias("b"), *[F.col(c).alias(f"l_{c}") for c in ("k", "host", "path", "lines")])
    right = ends.where("place = 0").select((F.col("rank") - 1).alias("b"), *[F.col(c).alias(f"r_{c}") for c in ("k", "host", "path", "lines")])
    met = left.join(right, "b").where("l_host = r_host").withColumn("likeness", F.length(common_prefix(F.col("l_path"), F.col("r_path"))))
    # equal likeness: the previous page
    own = ends.select("k", "likeness", "near", F.when(F.col("place") == 0, 1).otherwise(2).alias("order"))
    more = met.select(F.col("l_k").alias("k"), "likeness", F.col("r_lines").alias("near"), F.lit(1).alias("order")).unionByName(
        met.select(F.col("r_k").alias("k"), "likeness", F.col("l_lines").alias("near"), F.lit(2).alias("order")))
    edges = own.unionByName(more).groupBy("k").agg(F.max_by("near", F.struct("likeness", "order")).alias("near"))
    found = rows.where(~F.col("edge")).select("k", "near").unionByName(edges)
    usual = common_lines(narrow)
    return found.join(narrow.select("k", "host"), "k").join(usual, "host", "left").select("k", "near", "common")


def common_prefix(a, b):
    """The common beginning of two strings (a few rows only)."""
    both = F.sequence(F.lit(0), F.least(F.length(a), F.length(b)))
    return F.left(a, F.array_max(F.filter(both, lambda n: F.left(a, n) == F.left(b, n))))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    url = F.coalesce(F.col(quoted(url_col)), F.lit(""))
    keyed = pages.select(
        F.col(quoted(id_col)).alias("page_id"), F.col(quoted(url_col)).alias("url"), F.col(quoted(html_col)).alias("html"),
        F.xxhash64(F.col(quoted(id_col)), F.col(quoted(url_col)), F.col(quoted(html_col))).alias("k"),
        F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)).alias("host"),
        F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1).alias("path"))
    near = partners(keyed).select(F.col("k").alias("of"), "near", "common")
    joined = keyed.select("page_id", "url", "html", "k").join(near, F.col("k") == F.col("of"), "left")

    def make():
        def work(batch):
            partner, usual = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("near", "common"))
            found = ["\n\n".join(main_lines(lines_of(h), p or [], u or [])) for h, p, u in zip(texts(batch, "html"), partner, usual)]
            return [pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())]
        return work

    return with_computed(joined, "text string, n_chars long", make).select("page_id", "url", "text", "n_chars")
