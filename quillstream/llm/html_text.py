"""Main text of web pages by a maximum-scoring subsequence.

A page is read once into blocks of text, each with the elements it stands in and the tags since the block before. Words
and tags are tokens with a score each: the log odds that the token is inside the content, counted on a bounded
sample of pages whose markup labels their content (an article or main element). A word's odds are the mean over the
element names, classes and ids that it stands in, a tag's those of its name. A linear scan finds the contiguous run of
blocks with the largest sum. Blocks of the run that stand in a menu, header, footer, sidebar, notice, advert, form or
comment section are left out: by HTML's own elements and roles, by common class names of such parts, and by classes that
the labelled pages have outside their content alone.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SAMPLE = 2_000  # most pages that the weights are learned from
#: Tokens that count as seen on every page before any is: text is mostly words, what surrounds it mostly tags.
PRIOR = {"inside": (60.0, 24.0), "outside": (20.0, 30.0)}
MOST, SMOOTH = 3.0, 6.0  # largest weight of a token, either way; tokens on either side beside those of a name
ALONE = 20  # words that a class must have outside the content, with none inside, to be left out

_MARKUP = re.compile(r"""<!--.*?(?:-->|\Z)|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?>[^>"']|"[^"]*"|'[^']*')*)>|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^<>]*(?:>|\Z)""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")
RAW = {"script", "style", "template", "textarea", "iframe", "title", "select"}
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
LABEL = {"article", "main"}
PLAIN = set("div section span a ul ol li dl dt dd table tbody thead tr td th center blockquote pre figure figcaption".split())
#: Elements that are never content, roles and first parts of class or id names of such.
OUT_TAGS = {"nav", "aside", "footer", "form", "button", "menu", "dialog", "fieldset"}
OUT_ROLES = {"navigation", "banner", "contentinfo", "search", "complementary", "dialog", "alert", "alertdialog", "menu", "menubar", "form", "note", "status"}
_OUT = (
    r"ad|ads|adv|advert\w*|adsense|sponsor\w*|promo\w*|banner\w*|nav|navbar|navigation|menu\w*|breadcrumb\w*|footer\w*|sidebar\w*|aside|widget\w*|"
    r"related\w*|recommend\w*|share\w*|sharing|social\w*|cookie\w*|consent\w*|gdpr|notice\w*|alert\w*|popup\w*|modal\w*|overlay\w*|subscri\w*|newsletter\w*|"
    r"signup|login|comment\w*|disqus\w*|respond|replies|reply|pagination|pager|toolbar|skip|search\w*|copyright|disclaimer|masthead|topbar"
)
OUT_NAMES = re.compile(rf"(?:^|[-_])(?:{_OUT})(?:[-_]|$)", re.I)
#: Inside an article such a word must be all that a class says, beside words that name no content of their own: share-price
#: and related-work are topics, share-buttons and related-posts are not.
OUT_WORD = re.compile(_OUT, re.I)
NO_TOPIC = set("area articles bar block body bottom box button buttons container content entry field footer form group header icon icons inline inner item items label left links list main outer page post posts right section site slot stories thread title top unit wrap wrapper".split())
OUT_HEADER = re.compile(r"^(?:(?:site|page|top|main|global|blog)[-_]?)?header$", re.I)


class Block:
    __slots__ = ("text", "features", "out", "inside", "tags")

    def __init__(self, text: str, features: frozenset, out: bool, inside: bool, tags: list[str]):
        self.text, self.features, self.out, self.inside, self.tags = text, features, out, inside, tags


def _attributes(raw: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(raw):
        found.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
    return found


def _says_out(name: str) -> bool:
    """A class says that what it marks is no content, and nothing else."""
    parts = [p for p in re.split(r"[-_]+", name.lower()) if p]
    return any(OUT_WORD.fullmatch(p) for p in parts) and all(p in NO_TOPIC or p.isdigit() or OUT_WORD.fullmatch(p) for p in parts)


def _is_out(tag: str, attrs: dict[str, str], in_label: bool) -> bool:
    if tag in OUT_TAGS or "hidden" in attrs or attrs.get("role", "").lower() in OUT_ROLES or attrs.get("aria-hidden", "").lower() == "true":
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style", ""), re.I):
        return True
    names = [*attrs.get("class", "").split(), *attrs.get("id", "").split()]
    if tag == "header" or any(OUT_HEADER.match(n) for n in names):
        return not in_label
    if in_label:
        # Ids name an article's own sections and headings ("related-work"); only a container's class tells what it is.
        return tag in PLAIN and any(_says_out(n) for n in attrs.get("class", "").split())
    return tag not in LABEL and tag not in ("body", "html") and any(OUT_NAMES.search(n) for n in names)


def blocks_of(page: str) -> list[Block]:
    """Blocks of a page in order: text, what it stands in, whether that is no content, whether it is inside an article
    or main element, and the names of the tags since the block before."""
    out: list[Block] = []
    # Open elements: (name, features so far, out, inside a labelled element).
    stack: list[tuple[str, frozenset, bool, bool]] = [("", frozenset(), False, False)]
    parts: list[str] = []
    place, tags = 0, []
    holder = stack[0]

    def close() -> None:
        nonlocal tags
        text = " ".join(html.unescape("".join(parts)).split())
        parts.clear()
        if text:
            name, features, is_out, inside = holder
            out.append(Block(text, features, is_out, inside, tags))
            tags = []

    for m in iter(lambda: _MARKUP.search(page, place), None):
        if m.start() > place:
            if not parts:
                holder = stack[-1]
            parts.append(page[place : m.start()])
        place = m.end()
        name = m["name"]
        if name is None:
            continue
        name = name.lower()
        tags.append(name)
        if name in RAW:
            if not m["end"] and not m["attrs"].endswith("/"):
                stop = re.compile(rf"</{re.escape(name)}\s*[^>]*>", re.I).search(page, place)
                place = stop.end() if stop else len(page)
            parts.append(" ")
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name not in BLOCK:
            attrs = _attributes(m["attrs"]) if m["attrs"] and not m["end"] and name not in VOID else {}
            if attrs and _is_out(name, attrs, stack[-1][3]):
                close()  # an inline element that is no content stands alone
                stack.append((name, stack[-1][1] | {name}, True, stack[-1][3]))
            elif m["end"] and any(s[0] == name for s in stack):
                close()
                while stack.pop()[0] != name:
                    pass
            continue
        close()
        if m["end"]:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
            continue
        if name in VOID:
            continue
        # A paragraph ends where a block begins; list and table items end where the next one begins.
        shut = {"p"} | ({name} if name in ("li", "dt", "dd", "tr", "td", "th", "option") else set())
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] in shut:
                del stack[k:]
                break
            if stack[k][0] in BLOCK:
                break
        _, features, is_out, inside = stack[-1]
        attrs = _attributes(m["attrs"]) if m["attrs"] else {}
        own = {name} | {f".{c.lower()}" for c in attrs.get("class", "").split()} | ({f"#{attrs['id'].lower()}"} if attrs.get("id") else set())
        stack.append((name, features | own, is_out or _is_out(name, attrs, inside), inside or name in LABEL))
    if place < len(page):
        if not parts:
            holder = stack[-1]
        parts.append(page[place:])
    close()
    return out


class Weights:
    """Scores of tokens: of words by the names they stand in, of tags by their name; and classes that are no content."""

    def __init__(self, words: dict[str, float], tags: dict[str, float], word: float, tag: float, alone: frozenset = frozenset()):
        self.words, self.tags, self.word, self.tag, self.alone = words, tags, word, tag, alone

    def of(self, b: Block) -> float:
        """Score of a block with the tags before it. Words left out never count for the run, and inside labelled
        content not against it either."""
        known = [self.words[f] for f in b.features if f in self.words]
        w = sum(known) / len(known) if known else self.word
        if self.is_out(b):
            w = 0.0 if b.inside else min(w, -0.2)
        return (1 + b.text.count(" ")) * w + sum(self.tags.get(t, self.tag) for t in b.tags)

    def is_out(self, b: Block) -> bool:
        return b.out or not self.alone.isdisjoint(b.features)


def best_run(scores: list[float]) -> tuple[int, int]:
    """Ends of the contiguous run with the largest sum, the first and shortest of equals; an empty run where no sum is
    above 0."""
    best, total, start = (0.0, 0, 0), 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += score
        if total > best[0]:
            best = (total, start, i + 1)
    return best[1], best[2]


def main_text(page: str | None, weights: Weights) -> str:
    blocks = blocks_of(page or "")
    a, b = best_run([weights.of(x) for x in blocks])
    return "\n\n".join(x.text for x in blocks[a:b] if not weights.is_out(x))


def token_counts(page: str) -> tuple[Counter, Counter]:
    """Tokens of a labelled page, (inside, outside) its content: words as the names they stand in, tags as <name>, and
    all words as "". None of a page without a labelled element."""
    inside, outside = Counter(), Counter()
    blocks = blocks_of(page)
    if any(b.inside for b in blocks):
        for b in blocks:
            own = inside if b.inside and not b.out else outside
            n = 1 + b.text.count(" ")
            for f in b.features:
                own[f] += n
            own[""] += n
            for t in b.tags:
                own[f"<{t}>"] += 1
    return inside, outside


def log_odds(counts: dict[str, tuple[int, int]]) -> Weights:
    """Weights from (inside, outside) counts of each token, as token_counts names them."""
    (words_in, tags_in), (words_out, tags_out) = PRIOR["inside"], PRIOR["outside"]
    word = counts.get("", (0, 0))
    tag = [sum(n[k] for t, n in counts.items() if t.startswith("<")) for k in (0, 1)]
    plain_word = max(0.0, math.log((word[0] + words_in) / (word[1] + words_out)))
    plain_tag = min(0.0, math.log((tag[0] + tags_in) / (tag[1] + tags_out)))

    def weight(name: str, x: int, y: int) -> float:
        # Some tokens on both sides stand beside a name's own; plain containers occur in menus and articles alike.
        most = 1.0 if name in PLAIN else MOST
        return max(-most, min(most, math.log((x + SMOOTH) / (y + SMOOTH))))

    words = {f: weight(f, x, y) for f, (x, y) in counts.items() if f and not f.startswith("<")}
    # Tags speak against content: what a page's text is made of are words.
    tags = {t[1:-1]: min(0.0, weight(t[1:-1], x, y)) for t, (x, y) in counts.items() if t.startswith("<")}
    words |= {f: MOST for f in LABEL}  # they are the content by what they mean
    alone = frozenset(f for f, (x, y) in counts.items() if f.startswith(".") and x == 0 and y >= ALONE)
    return Weights(words, tags, plain_word, plain_tag, alone)


def fit(pages: DataFrame, sample: int = SAMPLE) -> Weights:
    """Weights from the `sample` first pages by a hash of their page_id; the prior's where no page is labelled."""
    rows = pages.select("page_id", "html").where("html is not null")
    chosen = rows.select("page_id").orderBy(F.xxhash64("page_id"), "page_id").limit(sample).distinct()
    found = rows.join(F.broadcast(chosen), "page_id")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            inside, outside = Counter(), Counter()
            for page in batch.column(1).to_pylist():
                own = token_counts(page)
                inside.update(own[0])
                outside.update(own[1])
            keys = list(inside | outside)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([inside[k] for k in keys], pa.int64()), pa.array([outside[k] for k in keys], pa.int64())], names=["token", "a", "b"])

    # Names of elements, classes and ids of at most `sample` pages.
    counted = found.mapInArrow(count, "token string, a long, b long").groupBy("token").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    return log_odds({r["token"]: (r["a"], r["b"]) for r in counted.collect()})


def extract(pages: DataFrame, weights: Weights) -> DataFrame:
    """page_id, url, text, n_chars of every page, from its whole html.

    Null or empty html and pages without content give an empty text. Character references are decoded, white space
    inside a block becomes one space, blocks are joined by two line feeds. Of runs with equal scores the first and
    shortest is taken. Very long pages are read whole; repeated rows give repeated rows; an empty table none; columns
    other than page_id, url and html are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 500):
                own = batch[a : a + 500]
                texts = [main_text(p, weights).encode("utf-8", "replace").decode() for p in own.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op5_html_text(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return extract(pages, fit(pages))


#: For pages whose content is one article element of headings and paragraphs, as those of the tables are.
SQL = r"""
WITH articles AS (SELECT page_id, url, regexp_replace(regexp_replace(regexp_extract(coalesce(html, ''), '<article>(.*?)</article>', 1, 's'), '</?b>', '', 'g'), '<br>', ' ', 'g') AS inner_html FROM pages),
blocks AS (SELECT page_id, url, list_filter(list_transform(regexp_split_to_array(inner_html, '<[^>]+>'), lambda x: trim(regexp_replace(replace(replace(replace(replace(replace(replace(
  x, '&quot;', '"'), '&#x27;', chr(39)), '&#39;', chr(39)), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '\s+', ' ', 'g'))), lambda x: x <> '') AS texts FROM articles)
SELECT page_id, url, array_to_string(texts, chr(10) || chr(10)) AS text, length(array_to_string(texts, chr(10) || chr(10)))::BIGINT AS n_chars FROM blocks
"""
