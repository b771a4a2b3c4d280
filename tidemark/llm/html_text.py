"""Main text of web pages by consensus host paths.

First each page's containers are scored by the text they hold directly, or in the
next level, less what is in links. Every page hands out 1000 votes to its
containers by score, under a generalised path: tags with their classes, digits
replaced, no positions. Votes are summed per host in Spark, before the shuffle and
after it, and the path with most votes wins. Then the pages of the host are read
again and give the blocks below the winning path; a page without that path gives
those of its own best container.

The path with most votes may be a part of the article only: its body without title
and lead, the largest of unlike sections, a long list. So it is raised to the
``article`` or ``main`` around it. Where there is none, it is raised to the lowest
ancestor that holds at least ``NEARLY_ALL`` of the text, and on through those that
have blocks of their own on half of the pages, short of ``body``.

Not text: whatever is inside menus, headers (but for an article's own), footers,
sidebars, notices, adverts, forms, scripts, styles and reader comments, told by
tag, role, or a whole class or id. What only sounds so and holds most of the page
stays (see ``_Doubts``); reader comments never do, also not as nested articles.

Defined results: null, empty or unfinished markup never fails; a null page has no
text; a page without a host votes with the others that have none; repeated rows
vote each; ties go to the path that sorts first.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.sources.scratch import written

# Element names of HTML, by what they do to text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|noscript|template|textarea|title|iframe|svg|math|object|canvas"
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
LEAF = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote td th figcaption summary address".split())
CELL = frozenset(("td", "th"))
SKIPPED = frozenset("head nav aside footer menu dialog button select option label fieldset".split())
SKIPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
# Names that sites give to what is no article, and the words they put before and after such a name.
NAMES = (
    "ad|ads|adv|advert|adverts|advertisement|advertising|adsense|banner|sponsor|sponsored|promo|promotion|sidebar|sidenav|menu|nav|navbar|"
    "navigation|breadcrumb|breadcrumbs|masthead|header|footer|notice|notices|cookie|cookies|consent|gdpr|popup|modal|overlay|newsletter|"
    "subscribe|subscription|signup|login|share|sharing|social|related|recommended|widget|pagination|pager|form|search|hidden"
)
COMMENTS = "comment|comments|commentlist|disqus|respond|reply|replies"
BEFORE = "site|page|main|global|top|bottom|left|right|primary|secondary|post|entry|article|user|reader|js|the"
AFTER = (
    "area|bar|block|body|bottom|box|buttons|container|content|count|author|meta|icons|inner|item|items|left|links|list|main|outer|panel|"
    "articles|posts|stories|right|section|slot|thread|title|top|unit|wrap|wrapper|fixed|sticky"
)
#: A container that sounds like no article, but holds more than this share of the page's text, is kept.
MOST = 2 / 3
#: Containers nested deeper count as part of the one at this depth.
DEPTH = 128
LONGEST_LABEL = 200
NEARLY_ALL = 0.8
#: An opening tag closes these, if one is open below the nearest container.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}

TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[/!?a-zA-Z][^>]*(?:>|\Z)|([^<]+|<)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"(?<![\w-])(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
OTHER = re.compile(rf"(?:(?:{BEFORE})[-_]+)*(?:{NAMES})(?:[-_]+(?:{NAMES}|{AFTER}))*[-_]*\d*")
READERS = re.compile(rf"(?:(?:{BEFORE})[-_]+)*(?:{COMMENTS})(?:[-_]+(?:{COMMENTS}|{AFTER}))*[-_]*\d*")
NO_MARK, SOUNDS_OTHER, BY_READERS = 0, 1, 2


def _marks(attributes: str) -> tuple[str, int]:
    """Generalised class label of an element, and whether a whole class, id or role says that it is no article text."""
    if not attributes or attributes.isspace():
        return "", NO_MARK
    classes, mark = [], NO_MARK
    for key, a, b, c in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), (a or b or c).lower()
        names = value.split()
        if key == "class":
            classes = sorted({re.sub(r"\d+", "#", x) for x in names})
        if key in ("class", "id"):
            if any(map(READERS.fullmatch, names)):
                mark = BY_READERS
            elif any(map(OTHER.fullmatch, names)):
                mark = max(mark, SOUNDS_OTHER)
        elif key == "hidden" or value == "true" or key == "role" and value in SKIPPED_ROLES:
            mark = max(mark, SOUNDS_OTHER)
    label = "".join(f".{x}" for x in classes)
    return (label if len(label) <= LONGEST_LABEL else f".{hashlib.md5(label.encode(errors='replace')).hexdigest()}"), mark


class _Doubts:
    """Containers that sound like no article: whether each is left out, known once the whole page is read.

    Reader comments always are, whatever is in them. Any other stays if it holds over
    ``MOST`` of the text outside comments, and no article stands beside it; a form
    that wraps the page also needs an article or a heading in it.
    """

    def __init__(self) -> None:
        self.parent, self.readers, self.within, self.form, self.headed = [-1], [False], [False], [False], [False]
        self.chars, self.article_chars = [0], [0]  # entry 0 is the page itself

    def add(self, parent: int, readers: bool, within: bool, form: bool) -> int:
        self.parent.append(parent)
        self.readers.append(readers or self.readers[parent])
        self.within.append(within)
        self.form.append(form)
        self.headed.append(False)
        self.chars.append(0)
        self.article_chars.append(0)
        return len(self.parent) - 1

    def count(self, at: int, chars: int, in_article: bool) -> None:
        if not self.readers[at]:
            self.chars[at] += chars
            self.article_chars[at] += chars if in_article else 0

    def left_out(self) -> list[bool]:
        held, headed = self.chars.copy(), self.headed.copy()
        for at in range(len(held) - 1, 0, -1):
            held[self.parent[at]] += held[at]
            headed[self.parent[at]] |= headed[at]
        out, beside = [False], [False]
        for at in range(1, len(held)):
            up = self.parent[at]
            beside.append(beside[up] or self.article_chars[up] > 0)
            stays = held[at] > MOST * held[0] and (self.within[at] or not beside[at]) and (headed[at] or not self.form[at])
            out.append(out[up] or self.readers[at] or not stays)
        return out


def blocks_of(page: str | None) -> list[tuple[tuple[str, ...], str, int]]:
    """Text blocks in page order: path of the containers around each, its text, and how many of its characters are links."""
    raw: list[tuple[tuple[str, ...], list[tuple[str, int, int]]]] = []
    tags: list[str] = []  # open elements; for each its path and the doubt it is in
    paths: list[tuple[str, ...]] = [()]
    doubt: list[int] = [0]
    opened: dict[str, list[int]] = {}  # depths of the open elements of each tag
    doubts = _Doubts()
    skip_at = 0  # depth from which nothing counts, 0 for none
    pieces: list[tuple[str, int, int]] = []  # text, doubt, characters in links

    def depth_of(tag: str) -> int:
        at = opened.get(tag)
        return at[-1] if at else -1

    def flush() -> None:
        nonlocal pieces
        if pieces:
            path = paths[-1]
            raw.append((path[:-1] if path and path[-1].split(".")[0] in LEAF else path, pieces))
            pieces = []

    def close(depth: int) -> None:
        nonlocal skip_at
        gone = tags[depth:]
        if any(tag in BLOCK and tag not in CELL for tag in gone):
            flush()
        elif pieces and any(tag in CELL for tag in gone):
            pieces.append((" ", doubt[-1], 0))
        for tag in gone:
            opened[tag].pop()
        del tags[depth:], paths[depth + 1 :], doubt[depth + 1 :]
        if skip_at > depth:
            skip_at = 0

    for match in TOKEN.finditer(page or ""):
        words = match[8]
        if words is not None:
            if not skip_at:
                plain = html.unescape(words) if "&" in words else words
                n = len(plain.strip())
                linked = n if opened.get("a") else 0
                pieces.append((plain, doubt[-1], linked))
                doubts.count(doubt[-1], max(0, n - 2 * linked), bool(opened.get("article") or opened.get("main")))
            continue
        name = match[3] or match[6]
        if name is None:
            if match[1] and pieces:
                pieces.append((" ", doubt[-1], 0))
            continue
        tag, ending = name.lower(), match[2] or match[5]
        if ending:
            if depth_of(tag) >= 0:
                close(depth_of(tag))
            continue
        if tag == "br":
            pieces.append((" ", doubt[-1], 0))
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if tag in BLOCK:
            if tag not in CELL and depth_of("p") >= 0:
                close(depth_of("p"))
            for depth in range(len(tags) - 1, -1, -1) if tag in CLOSES else ():
                if tags[depth] in CLOSES[tag]:
                    close(depth)
                    break
                if tags[depth] in ("ul", "ol", "dl", "table", "tbody", "div", "article", "section", "main"):
                    break
            if tag not in CELL:
                flush()
        attributes = match[4] if match[3] else match[7]
        if attributes.rstrip().endswith("/") and tag not in BLOCK:
            continue
        label, mark = _marks(attributes)
        in_article = bool(opened.get("article") or opened.get("main"))
        if tag in ("article", "main", "h1"):
            doubts.headed[doubt[-1]] = True
        own_header = tag == "header" and in_article
        if tag in ("html", "body") or mark == SOUNDS_OTHER and (own_header or tag in ("article", "main")):
            mark = NO_MARK
        elif tag == "form":
            mark = max(mark, SOUNDS_OTHER)
        opened.setdefault(tag, []).append(len(tags))
        tags.append(tag)
        paths.append((*paths[-1], tag + label) if tag in BLOCK and len(paths[-1]) < DEPTH else paths[-1])
        doubt.append(doubts.add(doubt[-1], mark == BY_READERS, in_article, tag == "form") if mark and not skip_at else doubt[-1])
        if not skip_at and (tag in SKIPPED or tag == "header" and not own_header):
            skip_at = len(tags)
    flush()

    left_out = doubts.left_out()
    out = []
    for path, parts in raw:
        kept = [part for part in parts if not left_out[part[1]]]
        words = " ".join("".join(part[0] for part in kept).split())
        if words:
            out.append((path, words, sum(part[2] for part in kept)))
    return out


def scores_of(blocks: list[tuple[tuple[str, ...], str, int]]) -> dict[str, float]:
    """Score of each container path: the text in it but for links, half as much from one level deeper."""
    scores: dict[str, float] = {}
    for path, words, link_chars in blocks:
        score = max(0, len(words) - 2 * link_chars)
        for up, share in ((0, 1.0), (1, 0.5)):
            if score and len(path) > up:
                key = ">".join(path[: len(path) - up])
                scores[key] = scores.get(key, 0.0) + score * share
    return scores


def best_path(scores: dict[str, float]) -> str:
    return min(scores, key=lambda path: (-scores[path], path), default="")


def shares_of(blocks: list[tuple[tuple[str, ...], str, int]]) -> dict[str, tuple[float, int]]:
    """For each container path and its ancestors up to "", the page: share of the text in it, and whether it has blocks of its own."""
    held: dict[tuple[str, ...], int] = {}
    for path, words, link_chars in blocks:
        held[path] = held.get(path, 0) + max(0, len(words) - 2 * link_chars)
    total, below = sum(held.values()), {}
    if not total:
        return {}
    for path, chars in held.items():
        key = ">".join(path)
        below[key] = below.get(key, 0) + chars
        for tag in reversed(path):
            key = key[: max(0, len(key) - len(tag) - 1)]
            below[key] = below.get(key, 0) + chars
    own = {">".join(path) for path, chars in held.items() if chars}
    return {key: (chars / total, int(key in own)) for key, chars in below.items()}


def raised(path: str, shares: dict[str, tuple[float, float]]) -> str:
    """``path``, or its ancestor that is the whole article; ``shares`` as in ``shares_of``, or their sums over pages."""
    steps = path.split(">") if path else []
    tags = [step.split(".")[0] for step in steps]
    if "article" in tags:
        return ">".join(steps[: tags.index("article") + 1])
    if "main" in tags:
        return ">".join(steps[: len(tags) - tags[::-1].index("main")])
    pages = shares.get("", (0, 0))[0]
    at = len(steps)
    while at > 1 and shares.get(">".join(steps[:at]), (0, 0))[0] < NEARLY_ALL * pages:
        at -= 1
    for up in range(at - 1, 0, -1):
        if tags[up - 1] in ("body", "html"):
            break
        if 2 * shares.get(">".join(steps[:up]), (0, 0))[1] >= pages:
            at = up
    return ">".join(steps[:at])


def text_below(blocks: list[tuple[tuple[str, ...], str, int]], path: str) -> str:
    """Blocks below ``path``, or below the page's own best container if it has none there."""
    steps = path.split(">") if path else []
    inside = [b[1] for b in blocks if steps and list(b[0][: len(steps)]) == steps]
    if not inside and blocks:
        own = raised(best_path(scores_of(blocks)), shares_of(blocks)).split(">")
        inside = [b[1] for b in blocks if list(b[0][: len(own)]) == own] or [b[1] for b in blocks]
    return "\n".join(inside)


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hosts, paths, votes, held, own = [], [], [], [], []
        for host, page in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            blocks = blocks_of(page.as_py())
            scores = scores_of(blocks)
            total = sum(scores.values())
            for path, (share, has_own) in shares_of(blocks).items():
                hosts.append(host)
                paths.append(path)
                votes.append(int(1000 * scores[path] / total) if path in scores else 0)
                held.append(round(1000 * share))
                own.append(1000 * has_own)
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), pa.array(paths, pa.string()), *(pa.array(x, pa.int64()) for x in (votes, held, own))],
            names=["host", "path", "votes", "held", "own"],
        )


def _raise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True)
        found = [raised(path, {x["up"]: (x["held"], x["own"]) for x in around}) for _, path, around in rows]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], names=["host", "path"])


def host_paths(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """``host`` and its winning ``path``, raised to the whole article."""
    votes = with_host(pages.select(url, page), url).select("host", page).mapInArrow(_votes, "host string, path string, votes bigint, held bigint, own bigint")
    best = Window.partitionBy("host").orderBy(F.desc("votes"), "path")
    summed = written(votes.groupBy("host", "path").agg(*[F.sum(x).alias(x) for x in ("votes", "held", "own")]), "votes")
    won = summed.filter("path <> ''").withColumn("_n", F.row_number().over(best)).filter("_n = 1").select(F.col("host").alias("_host"), F.col("path").alias("_path"))
    above = (F.col("path") == "") | (F.col("path") == F.col("_path")) | F.col("_path").startswith(F.concat("path", F.lit(">")))
    around = F.collect_list(F.struct(F.col("path").alias("up"), "held", "own")).alias("around")
    steps = summed.join(won, (F.col("host") == F.col("_host")) & above).groupBy("host", "_path").agg(around)
    return steps.mapInArrow(_raise, "host string, path string")


def with_host(pages: DataFrame, url: str = "url") -> DataFrame:
    return pages.withColumn("host", F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"://([^/?#]*)", 1)))


def extract(pages: DataFrame, url: str = "url", page: str = "html", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of ``pages`` as a struct ``_row``, the main ``text``, ``n_chars`` and the ``path`` it came from.

    The winning paths are written once; their size tells Spark whether to
    broadcast them or to join by shuffle, where it splits a host that holds a
    large share of the pages.
    """
    keep = pages.columns if keep is None else keep
    paths = written(host_paths(pages, url, page).withColumnRenamed("host", "_host"), "paths")
    packed = with_host(pages.select(F.struct(*keep).alias("_row"), F.col(page).alias("_page"), F.col(url).alias("_url")), "_url")
    joined = packed.join(paths, F.col("host") == F.col("_host"), "left").select("_row", "_page", "path")
    schema = joined.select("_row", F.lit("").alias("text"), F.lit(0).cast("bigint").alias("n_chars"), F.col("path")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                text_below(blocks_of(page.as_py()), path or "")
                for page, path in zip(batch.column(1), batch.column(2).to_pylist(), strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), batch.column(2)],
                names=["_row", "text", "n_chars", "path"],
            )

    return joined.mapInArrow(run, schema)
