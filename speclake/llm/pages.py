"""Main-text extraction from HTML by a linear-chain conditional random field over DOM leaf blocks."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from speclake.llm.common import cut

#: Tags that start and end a block of text.
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul legend".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Content that is never text of a page.
SILENT = frozenset("script style title head noscript template svg math iframe object textarea select option button canvas audio video".split())
#: Of these all is text up to their end tag.
RAW = frozenset("script style textarea title".split())
#: What a block tag ends that is left open, as no block but a div can stand in it.
PHRASES = frozenset("select option button textarea".split())
#: Ended by the next one of its kind.
ITEMS = frozenset("li tr td th dt dd".split())
HEAD_PARTS = frozenset("base link meta title script style noscript template head".split())
OPEN = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
QUOTE = re.compile(r"=\s*(?=[\"'])")
NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
#: What class names, ids and roles of page furniture are made of.
HINT = re.compile(r"^(nav\w*|menus?|breadcrumbs?|head|header|masthead|foot|footer|side|sidebar|aside|widgets?|ads?|adverts?|advert\w+|sponsor\w*|promo\w*|banner|cookies?|consent|notices?|alerts?|popup|modal|newsletter|subscribe|signup|login|forms?|search|share|sharing|social|related|recommend\w*|comments?|commentlist|reply|replies|discussion|disqus|copyright|legal|pagination|pager|toolbar|contentinfo|complementary|navigation)$")
#: What short blocks beside the main text hold.
MARK = re.compile("[©·|»]")
MAIN = re.compile(r"^(article|content|main|post|entry|story|body|text)$")
#: Hints at what readers wrote, however much it is.
COMMENTS = frozenset(("comment", "comments", "commentlist", "reply", "replies", "discussion", "disqus"))
#: How many names of the nearest elements around a block training looks at; afterwards all names count that it has learned.
NAMES_TRAINED = 16
FURNITURE = ("nav", "header", "footer", "aside", "form", "menu", "dialog")
#: Weights that training starts from and is drawn to: of (feature, main text).
PRIOR = {"hint": -8.0, "in:article": 1.5, "in:main": 1.0, "name:main": 1.0, "links:most": -1.5, "links:none": 0.2, "words:many": 1.0, "words:some": 0.5, "words:few": -0.3, "stop": 0.3, "mark": -1.0, "tag:p": 0.5, "tag:li": -0.3} | {f"in:{t}": -7.0 for t in FURNITURE}


#: Features that name page furniture or main text.
TELLING = re.compile(rf"hint|called:|name:|comments$|in:(?:article|main|{'|'.join(FURNITURE)})$|tag:(?:{'|'.join(FURNITURE)})$")


class Scanner:
    """Pieces of a page in order: (text, '', ''), or ('', tag, attributes) with a slash before the name of an end tag. Time grows with the page's length only, whatever is left open or unbalanced."""

    def __init__(self, page: str):
        self.page, self.low = page, page.lower()
        if len(self.low) != len(page):  # a few letters have longer lower cases
            self.low = "".join(c if len(c.lower()) > 1 else c.lower() for c in page)
        self.gone: set[str] = set()
        self.last: dict[str, int] = {}
        self.at = 0

    def ends(self, tag: str) -> bool:
        """Is there an end tag of this name in the rest of the page?"""
        if tag not in self.last:
            self.last[tag] = self.low.rfind(f"</{tag}")
        return self.last[tag] >= self.at

    def find(self, what: str, at: int) -> int:
        """The first place of ``what`` from ``at`` on; once there is none, no later search looks again."""
        if what in self.gone:
            return -1
        found = self.low.find(what, at)
        if found < 0:
            self.gone.add(what)
        return found

    def end_of_tag(self, at: int) -> int:
        """The place of the > that ends a tag; one inside of a quoted value doesn't."""
        while True:
            end = self.find(">", at)
            if end < 0:
                return -1
            m = QUOTE.search(self.page, at, end)
            if m is None:
                return end
            shut = self.find(self.page[m.end()], m.end() + 1)
            if shut < 0:
                return end
            at = shut + 1

    def __iter__(self) -> Iterator[tuple[str, str, str]]:
        page, at, n = self.page, 0, len(self.page)
        while at < n:
            start = page.find("<", at)
            if start != at:
                yield page[at : start if start >= 0 else n], "", ""
                if start < 0:
                    return
            if page.startswith("<!--", start):
                end = self.find("-->", start + 4)
                at = n if end < 0 else end + 3
                continue
            m = OPEN.match(page, start + 1)
            end = self.end_of_tag(m.end()) if m else self.find(">", start) if page[start + 1 : start + 2] in ("!", "?") else -1
            if end < 0:
                yield "<", "", ""
                at = start + 1
                continue
            self.at = at = end + 1
            if m:
                tag = m[2].lower()
                yield "", m[1] + tag, page[m.end() : end]
                if tag in RAW and not m[1]:
                    end = self.find(f"</{tag}", at)
                    at = n if end < 0 else end


class Element:
    """An open element: what its blocks inherit from it and from those around it. Kinds of features are few, and names are those of the nearest elements, so both stay small however deep it is."""

    __slots__ = ("article", "features", "names", "number", "plain", "silent", "tag", "words")

    def __init__(self, tag: str, around: Element | None, names: list[str], number: int, words: int, plain: int, wide: bool, known: frozenset[str] | None):
        self.tag, self.number, self.words, self.plain = tag, number, words, plain
        self.silent = tag in SILENT or around is not None and around.silent
        self.article = tag in ("article", "main") or around is not None and around.article
        own = {f"in:{_kind(tag)}"} if tag in BLOCKS and tag not in ("html", "body", "div") else set()  # a div tells nothing
        if tag == "header" and around is not None and around.article:
            own.discard("in:header")  # of the article, not of the page
        hints = {w for w in names if HINT.match(w)} - ({"header", "head"} if self.article else set())
        if wide:
            own, hints = {x for x in own if x.removeprefix("in:") not in FURNITURE}, set()
        if hints:
            own.add("hint")
        if hints & COMMENTS:
            own.add("comments")
        if any(MAIN.match(w) for w in names):
            own.add("name:main")
        before = around.features if around is not None else frozenset()
        self.features = before if own <= before else before | own
        called = [f"hint:{w}" if w in hints else f"called:{w}" for w in names]
        above = around.names if around is not None else ()
        if known is None:
            self.names = (*called, *above)[:NAMES_TRAINED]
        else:  # as many as were learned at most, so this stays bounded, too
            more = [c for c in called if c in known and c not in above]
            self.names = (*more, *above) if more else above


def leaf_blocks(page: str, known: frozenset[str] | None = None) -> list[tuple[str, list[str]]]:
    """(text, features) of each leaf block of a page, in order; of names those that are ``known``, or without these the nearest ones.

    A block is the text between two borders of block tags; inline tags and line breaks don't end it.
    Features: ancestor tags, the nearest block tag, words of the nearest ancestors' class, id and role, and whether any
    of them hints at page furniture or main text, share of linked words, number of words, how it ends, whether it comes
    before, among or after the long blocks, and what its neighbours are like. Ancestors that look like furniture don't count as it if they hold a
    headline or an article and over half of the page's words, or are a form or a named wrapper with over half of its unlinked words.
    """
    blocks, wide = _blocks(page, frozenset(), known)
    found = _blocks(page, wide, known)[0] if wide else blocks
    long = [i for i, (_, f) in enumerate(found) if "words:many" in f]
    for i, (_, features) in enumerate(found):
        features.append("at:none" if not long else "at:before" if i < long[0] else "at:after" if i > long[-1] else "at:among")
        for side, j in (("before", i - 1), ("behind", i + 1)):
            beside = found[j][1] if 0 <= j < len(found) else []
            features += [f"{side}:{x}" for x in ("links:most", "words:many", "words:few") if x in beside]
    return found


def _blocks(page: str, wide: frozenset[int], known: frozenset[str] | None) -> tuple[list[tuple[str, list[str]]], frozenset[int]]:
    """The blocks, and the numbers of the elements that are to count as wide."""
    stack: list[Element] = []
    holders: list[Element] = []  # the open block elements
    opened: Counter = Counter()
    blocks: list[tuple[str, list[str]]] = []
    pieces: list[str] = []
    candidates: list[tuple[int, int, int]] = []
    headed: list[int] = []  # words before each headline, article or main
    linked = words = plain = number = 0  # plain: words that aren't linked

    def close() -> None:
        nonlocal pieces, linked, words, plain
        text = " ".join(html.unescape("".join(pieces)).split())
        if text:
            tag = holders[-1].tag if holders else "none"
            words += text.count(" ") + 1
            plain += max(0, text.count(" ") + 1 - linked)
            blocks.append((text, _features(text, linked, {*stack[-1].features, *stack[-1].names} if stack else set(), tag)))
        pieces, linked = [], 0

    def pop() -> None:
        top = stack.pop()
        opened[top.tag] -= 1
        if holders and holders[-1] is top:
            holders.pop()
        if top.tag in FURNITURE or "hint" in top.features and "comments" not in top.features:
            headline = any(x >= top.words for x in headed[-1:])
            wrapper = top.tag == "form" or top.tag not in FURNITURE
            candidates.append((top.number, words - top.words if headline else 0, plain - top.plain if wrapper else 0))

    def pop_to(tag: str) -> None:
        while opened[tag]:
            found = stack[-1].tag == tag
            pop()
            if found:
                return

    scanner = Scanner(page)
    for text, tag, attributes in scanner:
        if not tag:
            if stack and stack[-1].tag == "head" and not text.isspace():
                pop()
            if not (stack and stack[-1].silent):
                pieces.append(text)
                if opened["a"]:
                    linked += len(text.split())
            continue
        name = tag.removeprefix("/")
        if name in BLOCKS:
            close()
        elif name == "br":
            pieces.append(" ")
        if tag != name:
            pop_to(name)
            continue
        if opened["head"] and name not in HEAD_PARTS:
            pop_to("head")
        if name in BLOCKS and name != "div":
            while stack and stack[-1].silent and stack[-1].tag in PHRASES:
                pop()
            if holders and (holders[-1].tag == "p" or holders[-1].tag == name and name in ITEMS):
                pop_to(holders[-1].tag)
        elif name == "div" and holders and holders[-1].tag == "p" or name in PHRASES and opened[name]:
            pop_to("p" if name == "div" else name)
        number += 1
        if name in ("h1", "article", "main"):
            headed.append(words)
        # What is never text and has no end tag any more would swallow the rest.
        if name in VOID or attributes.endswith("/") or name in SILENT and name != "head" and not scanner.ends(name):
            continue
        stack.append(Element(name, stack[-1] if stack else None, _names(attributes), number, words, plain, number in wide, known))
        opened[name] += 1
        if name in BLOCKS:
            holders.append(stack[-1])
    close()
    while stack:
        pop()
    return blocks, frozenset(k for k, n, m in candidates if 2 * n > words or 2 * m > plain)


def _names(attributes: str) -> list[str]:
    """The words of an element's class, id and role."""
    if "=" not in attributes:
        return []
    said = " ".join("".join(found) for found in NAMES.findall(attributes))
    return list(dict.fromkeys(w for w in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", said).lower()) if w))


def _kind(tag: str) -> str:
    """Headlines of all levels are of one kind."""
    return "headline" if re.fullmatch("h[1-6]", tag) else tag


def _features(text: str, linked: int, found: set[str], tag: str) -> list[str]:
    n = text.count(" ") + 1
    if tag not in ("div", "none"):
        found.add(f"tag:{_kind(tag)}")
    elif n < 25:
        found.add("loose")
    found.add("links:most" if 2 * linked > n else "links:some" if linked else "links:none")
    found.add("words:many" if n >= 25 else "words:some" if n >= 8 else "words:few")
    if text[-1] in ".!?…\"”":
        found.add("stop")
    if n < 25 and MARK.search(text):
        found.add("mark")
    found.add("bias")
    return sorted(found)


def weak_label(features: list[str]) -> int | None:
    """What the tags around a block say, whatever they are called: 1 inside of <article> or <main>, 0 outside and for page furniture; None inside of an article, but in an element named like furniture."""
    if any(f"in:{t}" in features for t in FURNITURE) or not ("in:article" in features or "in:main" in features):
        return 0
    return None if "hint" in features else 1


class Field:
    """A linear-chain CRF with labels 0 (furniture) and 1 (main text): weights of features for label 1, and of label pairs."""

    def __init__(self, weights: dict[str, float] | None = None, pairs: np.ndarray | None = None):
        self.weights = dict(PRIOR if weights is None else weights)
        self.pairs = np.array([[0.5, -0.5], [-0.5, 0.5]]) if pairs is None else pairs

    def scores(self, sequence: list[list[str]]) -> np.ndarray:
        get = self.weights.get
        return np.array([sum(get(f, 0.0) for f in features) for features in sequence])

    def decode(self, sequence: list[list[str]]) -> list[int]:
        """Viterbi: the best labels; of equal ones main text."""
        if not sequence:
            return []
        (p00, p01), (p10, p11) = self.pairs.tolist()
        back, zero, one = [], 0.0, None
        for s in self.scores(sequence).tolist():
            if one is None:
                zero, one = 0.0, s
                continue
            from0, from1 = int(one + p10 >= zero + p00), int(one + p11 >= zero + p01)
            zero, one = max(zero + p00, one + p10), max(zero + p01, one + p11) + s
            back.append((from0, from1))
        labels = [int(one >= zero)]
        for step in reversed(back):
            labels.append(step[labels[-1]])
        return labels[::-1]

    def marginals(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probability of label 1 at each place, and summed probabilities of label pairs."""
        n, unary = len(s), np.stack([np.zeros(len(s)), s], axis=1)
        ahead, behind = np.zeros((n, 2)), np.zeros((n, 2))
        ahead[0] = unary[0]
        for i in range(1, n):
            ahead[i] = unary[i] + np.logaddexp(ahead[i - 1, 0] + self.pairs[0], ahead[i - 1, 1] + self.pairs[1])
        for i in range(n - 2, -1, -1):
            behind[i] = np.logaddexp(self.pairs[:, 0] + unary[i + 1, 0] + behind[i + 1, 0], self.pairs[:, 1] + unary[i + 1, 1] + behind[i + 1, 1])
        total = np.logaddexp(*ahead[-1])
        both = np.exp(ahead[:-1, :, None] + self.pairs + (unary + behind)[1:, None, :] - total).sum(axis=0)
        return np.exp(ahead[:, 1] + behind[:, 1] - total), both

    def fit(self, pages: list[tuple[list[list[str]], list[int]]], rounds: int = 6, rate: float = 0.1, pull: float = 0.002) -> Field:
        """Gradient steps on the log-likelihood, page by page, drawn to the prior."""
        for _ in range(rounds):
            for sequence, labels in pages:
                truth = np.array(labels)
                likely, both = self.marginals(self.scores(sequence))
                for features, g in zip(sequence, (truth - likely).tolist(), strict=True):
                    for f in features:
                        w = self.weights.get(f, 0.0)
                        self.weights[f] = w + rate * (g - pull * (w - PRIOR.get(f, 0.0)))
                seen = np.zeros((2, 2))
                np.add.at(seen, (truth[:-1], truth[1:]), 1)
                self.pairs = self.pairs + rate * (seen - both) / len(truth)
        return self


def training_pages(pages: DataFrame, sample_rows: int, page_chars: int = 200_000) -> list[str]:
    """The first ``sample_rows`` distinct html of ``pages`` of at most ``page_chars`` by hash; copies of a page count once."""
    # Only html of small hash, about four times the sample, takes part in the ordering, however many there are.
    among, digest = F.pmod(F.xxhash64("html"), F.lit(1 << 30)), F.unhex(F.md5("html"))
    usable = pages.filter(F.length("html").between(1, page_chars)).select("html")
    keys = cut(usable.select(among.alias("among"), digest.alias("digest")).distinct())
    share = 4.0 * sample_rows / max(1, keys.count())
    first = F.broadcast(keys.filter(F.col("among") < share * (1 << 30)).orderBy("among", "digest").limit(sample_rows))
    rows = usable.withColumn("among", among).join(first, "among").filter(digest == F.col("digest")).groupBy("among", "digest").agg(F.first("html").alias("html"))
    return [r["html"] for r in sorted(rows.collect(), key=lambda r: (r["among"], bytes(r["digest"])))]


def train_field(pages: DataFrame, sample_rows: int = 300) -> Field:
    """A field trained on a bounded sample: the first ``sample_rows`` distinct pages by hash of their html, those of over 200,000 characters left out.

    Labels are what tags say of a block (``weak_label``), not names; pages without an article and those with unlabelled
    blocks are left out. Each page is taken three times: as it is; without the features that gave its main text
    away, so that the other features, all names of classes among them, learn to tell it; and without any tag or name that tells
    furniture either, so that place, length, links and neighbours learn to tell both. Without such pages the prior stands.
    """
    labelled = []
    for page in training_pages(pages, sample_rows):
        sequence = [f for _, f in leaf_blocks(page)]
        labels = [weak_label(f) for f in sequence]
        if sequence and None not in labels and 1 in labels:
            bare = [[x for x in f if x not in ("in:article", "in:main", "name:main")] for f in sequence]
            nameless = [[x for x in f if not TELLING.match(x)] for f in sequence]
            labelled += [(sequence, labels), (bare, labels), (nameless, labels)]
    return Field().fit(labelled)


def extract_text(pages: DataFrame, field: Field | None = None) -> DataFrame:
    """Main text of every page: ``pages`` (page_id, url, html) to (page_id, url, text, n_chars, n_blocks, n_kept).

    Blocks that the field labels as main text, character references decoded and white space made one
    space, are joined by an empty line. Null and empty html give an empty text; malformed html is read
    as far as tags can be told; repeated rows stay; an empty table gives an empty result.
    """
    model = pages.sparkSession.sparkContext.broadcast(field or train_field(pages))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trained = model.value
        known = frozenset(w for w in trained.weights if w.startswith(("called:", "hint:")))
        for batch in batches:
            texts, blocks, kept = [], [], []
            for page in batch.column(2).to_pylist():
                found = leaf_blocks(page or "", known)
                main = [t for (t, _), label in zip(found, trained.decode([f for _, f in found]), strict=True) if label]
                texts.append("\n\n".join(main))
                blocks.append(len(found))
                kept.append(len(main))
            longs = [pa.array(x, pa.int64()) for x in ([len(t) for t in texts], blocks, kept)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), *longs], ["page_id", "url", "text", "n_chars", "n_blocks", "n_kept"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long, n_blocks long, n_kept long")
