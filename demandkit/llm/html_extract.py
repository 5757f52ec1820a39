"""The main text of web pages: boosted trees judge DOM nodes, a pass over the tree decides.

Every block element gets features of its subtree, place, surroundings and attribute words, and the
log odds of being part of the article. The choice is hierarchical: a kept node needs kept
ancestors, a dropped node drops all below it, and of all such choices the one with the largest sum
of log odds is taken, by one pass from the leaves to the root.

The pages carry no labels. The model is trained on pages put together from the texts of a bounded
sample of the given pages, laid out by random templates in which it is known what the article is.
"""

from __future__ import annotations

import random
import re
import warnings
from collections.abc import Iterator, Sequence
from functools import partial
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from demandkit.llm.boosting import BoostedTrees, fit
from demandkit.llm.common import arrow_map, hash_sample
from demandkit.llm.dom import Page, read

#: Pages whose texts are used to put the training pages together, and how many of these are made.
TRAIN_PAGES = 200
MADE_PAGES = 1500
#: Characters of these pages together: a page that does not fit any more is left out of the sample.
TRAIN_CHARS = 8_000_000
TOKEN_BINS = 24
_BATCH_CHARS = 1 << 21

# fixed values: what authors of pages call their blocks
ARTICLE_WORDS = frozenset("article articlebody body content entry hentry main maincontent news page post postbody prose story text".split())
OTHER_WORDS = frozenset(
    "ad ads adv advert advertisement adverts aside author banner bar breadcrumb breadcrumbs button byline caption category "
    "comment comments consent contact cookie cookies copyright cta dialog disclaimer discussion disqus feedback foot footer "
    "form gdpr header hidden legal links login logo masthead menu meta modal nav navbar navigation newsletter notice "
    "notification outbrain overlay pager pagination popular popup promo promoted promotion reader readers recommended "
    "related replies reply respond response search share sharing sidebar signup skip social sponsor sponsored subscribe "
    "subscription tag tags teaser toolbar tools top trending widget widgets".split()
)
_TAGS = ("article", "main", "section", "div", "p", "head", "list", "item", "nav", "header", "footer", "aside", "form", "table", "quote", "other")
_GROUPS = {
    **{t: i for i, t in enumerate(_TAGS)},
    **{f"h{n}": _TAGS.index("head") for n in range(1, 7)},
    **{t: _TAGS.index("list") for t in ("ul", "ol", "dl", "menu")},
    **{t: _TAGS.index("item") for t in ("li", "dt", "dd")},
    **{t: _TAGS.index("table") for t in ("tr", "td", "th", "thead", "tbody", "tfoot")},
    **{t: _TAGS.index("quote") for t in ("blockquote", "pre", "figure")},
    "fieldset": _TAGS.index("form"),
}
_GROUPS.pop("head", None)


def features(pages: Sequence[Page]) -> np.ndarray:
    """One row per node of all pages, one page after the other."""
    nodes = [n for p in pages for n in p.nodes]
    counts = np.array([len(p.nodes) for p in pages])
    first = np.cumsum(counts) - counts
    page = np.repeat(np.arange(len(pages)), counts)
    parent = np.array([n.parent for n in nodes]) + first[page]
    depth = np.array([n.depth for n in nodes])
    own = np.array([(n.text, n.words, n.marks, n.links, n.blocks, n.controls, 1, n.children) for n in nodes], float)
    group = np.array([_GROUPS.get(n.tag, len(_TAGS) - 1) for n in nodes])
    tags = np.zeros((len(nodes), len(_TAGS)))
    tags[np.arange(len(nodes)), group] = 1
    words = np.zeros((len(nodes), 2 + TOKEN_BINS))
    for i, n in enumerate(nodes):
        for token in n.tokens:
            words[i, 0] += token in ARTICLE_WORDS
            words[i, 1] += token in OTHER_WORDS or token.endswith("s") and token[:-1] in OTHER_WORDS
            words[i, 2 + crc32(token.encode()) % TOKEN_BINS] = 1

    below = own.copy()
    above_tags, above_words = np.zeros_like(tags), np.zeros_like(words[:, :2])
    alike = np.bincount(parent * len(_TAGS) + group, minlength=len(nodes) * len(_TAGS))[parent * len(_TAGS) + group]
    for level in range(int(depth.max(initial=0)), 0, -1):
        at = np.flatnonzero(depth == level)
        np.add.at(below, parent[at], below[at])
    for level in range(1, int(depth.max(initial=0)) + 1):
        at = np.flatnonzero(depth == level)
        above_tags[at] = np.maximum(above_tags[parent[at]], tags[parent[at]])
        above_words[at] = above_words[parent[at]] + words[parent[at], :2]
    total = below[first, 0][page] + 1
    size = below[:, 0] + 1
    place = np.array([(n.place, n.before) for n in nodes], float)
    siblings = own[parent, 7]
    columns = [
        depth, place[:, 0], siblings, alike / np.maximum(siblings, 1),
        np.log1p(below[:, 0]), np.log1p(own[:, 0]), below[:, 3] / size, below[:, 6] / size, below[:, 2] / size,
        below[:, 1] / np.maximum(below[:, 4], 1), place[:, 1] / total, below[:, 0] / total, below[:, 5], own[:, 7],
        np.log1p(below[parent, 0]), below[parent, 3] / (below[parent, 0] + 1),
    ]
    return np.column_stack([*columns, tags, tags[parent], above_tags, words, words[parent, :2], above_words]).astype(np.float32)


def choose(page: Page, odds: np.ndarray) -> list[bool]:
    """The nodes kept: the choice of largest summed log odds in which a kept node's parent is kept."""
    gain = odds.tolist()
    for i in range(len(page.nodes) - 1, 0, -1):  # children follow their parents
        if gain[i] > 0:
            gain[page.nodes[i].parent] += gain[i]
    kept = [True] * len(gain)
    for i in range(1, len(gain)):
        kept[i] = gain[i] > 0 and kept[page.nodes[i].parent]
    return kept


# ---- training pages


def made_page(rnd: random.Random, long: Sequence[str], short: Sequence[str]) -> str:
    """A page of a random layout; ``data-y`` is 1 on nodes of the article and on what holds it."""

    brief = rnd.random()  # some pages have hardly any text

    def text(most: int) -> str:
        words = rnd.choice(long).split()
        n = rnd.choice([1, 3, 8, 20, 60, 200]) if brief < 0.7 else rnd.randint(1, 12)
        at = rnd.randrange(max(1, len(words) - n))
        return " ".join(words[at : at + min(n, most)])

    def links(n: int) -> str:
        return "".join(f"<li><a href='/x'>{rnd.choice(short)}</a></li>" for _ in range(n))

    def other(kind: str) -> str:
        plain = rnd.random() < 0.4
        tag, name, inside = "div", kind, text(40)
        if kind in ("nav", "menu", "breadcrumb", "related", "social", "tags"):
            inside = f"<ul>{links(rnd.randint(2, 9))}</ul>"
            if rnd.random() < 0.3:
                inside = f"<h3>{rnd.choice(short)}</h3>" + inside
            tag = rnd.choice(["nav", "div", "aside"]) if not plain else "nav"
        elif kind in ("header", "footer"):
            tag = kind if plain or rnd.random() < 0.6 else "div"
            inside = rnd.choice([f"<p>{text(30)}</p>", text(30), f"<h1>{rnd.choice(short)}</h1><p>{text(20)}</p>", "&copy; " + text(20)])
        elif kind in ("sidebar", "widget"):
            tag = "aside" if plain or rnd.random() < 0.5 else "div"
            inside = "".join(f"<section><h3>{rnd.choice(short)}</h3><p>{text(60)}</p><ul>{links(rnd.randint(0, 4))}</ul></section>" for _ in range(rnd.randint(1, 3)))
        elif kind in ("newsletter", "search", "login", "contact"):
            tag, inside = "form", f"<label>{rnd.choice(short)}</label><p>{text(20)}</p><input name=a><button>{rnd.choice(short)}</button>"
            if rnd.random() < 0.4:
                tag, inside = "div", f"<form>{inside}</form>"
        elif kind in ("comments", "replies", "discussion"):
            one = rnd.choice(["li", "div", "article"])
            inside = "".join(f"<{one} class='{rnd.choice(['comment', 'reply', 'comment-body'])}'><p>{text(80)}</p></{one}>" for _ in range(rnd.randint(1, 6)))
            tag, inside = rnd.choice(["section", "div", "aside"]), f"<h3>{rnd.choice(short)}</h3>" + inside
            plain = False
        else:  # adverts, notices
            inside = rnd.choice([text(60), f"<p>{text(60)}</p>", f"<p>{text(30)}</p><a href='/y'>{rnd.choice(short)}</a>"])
            plain = False
        ending = rnd.choice(["", "", "-box", "-wrapper", " block", "-" + rnd.choice(["top", "left", "1", "area"])])
        attribute = "" if plain and tag in ("nav", "header", "footer", "aside", "form") else f' {rnd.choice(["class", "class", "id"])}="{name}{ending}"'
        return f'<{tag}{attribute} data-y="0">{inside}</{tag}>'

    kinds = "nav menu breadcrumb related social tags header footer sidebar widget newsletter search login contact comments replies discussion ad advert banner sponsored promo cookie-notice notice consent popup disclaimer".split()
    blocks = []
    if rnd.random() < 0.8:
        blocks.append(f"<h1>{text(12)}</h1>")
    for _ in range(rnd.choice([1, 1, 2, 4, 8, 20])):
        kind = rnd.random()
        if kind < 0.75:
            blocks.append(rnd.choice(["<p>{}</p>", "<p>{}</p>", "<p>{}", "<p><b>{}<br>"]).format(text(200)))
        elif kind < 0.83:
            blocks.append(f"<h2>{text(8)}</h2>")
        elif kind < 0.9:
            blocks.append("<ul>" + "".join(f"<li>{text(20)}</li>" for _ in range(rnd.randint(1, 5))) + "</ul>")
        elif kind < 0.95:
            blocks.append(f"<blockquote>{rnd.choice(['{}', '<p>{}</p>']).format(text(60))}</blockquote>")
        else:
            blocks.append(f"<table><tr><td>{text(8)}</td><td>{text(8)}</td></tr></table>")
    for _ in range(rnd.choice([0, 0, 0, 1, 2])):
        blocks.insert(rnd.randint(1, len(blocks)), other(rnd.choice(kinds[10:])))
    tag, name = rnd.choice([("article", ""), ("article", ""), ("article", "post"), ("main", ""), ("div", "content"), ("div", "post-body"), ("div", "article"), ("div", "main"), ("section", "story"), ("div", "entry-content"), ("div", "text")])
    attribute = f' {rnd.choice(["class", "id"])}="{name}"' if name else ""
    body = f'<{tag}{attribute} data-y="1">{"".join(blocks)}</{tag}>'
    if rnd.random() < 0.4:
        body = f'<{rnd.choice(["main", "div", "div class=wrapper", "div id=page", "section"])} data-y="1">{rnd.choice(["", other(rnd.choice(kinds))])}{body}{rnd.choice(["", other(rnd.choice(kinds))])}'
        body += "</main>" if body.startswith("<main") else "</section>" if body.startswith("<section") else "</div>"
    before = "".join(other(rnd.choice(kinds)) for _ in range(rnd.randint(0, 4)))
    after = "".join(other(rnd.choice(kinds)) for _ in range(rnd.randint(0, 4)))
    return f'<html><head><title>{text(9)}</title></head><body data-y="1">{before}{body}{after}' + rnd.choice(["</body></html>", ""])


def labelled(page: Page) -> np.ndarray:
    """A node without a label has its parent's; a page's root is part of what is kept."""
    made: list[int] = []
    for node in page.nodes:
        made.append(1 if not made else int(node.label) if node.label is not None and made[node.parent] else made[node.parent])
    return np.array(made)


def train(sample: Sequence[str], made_pages: int = MADE_PAGES, seed: int = 7) -> BoostedTrees:
    """A model from the texts of ``sample`` pages."""
    blocks = sorted({t for s in sample for _, t in read(s).blocks})
    long = [re.sub(r"[<>&]", " ", t) for t in blocks if t.count(" ") > 7] or ["some words of a page that has hardly any text"]
    short = [re.sub(r"[<>&]", " ", t) for t in blocks if t.count(" ") < 4] or ["more"]
    rnd = random.Random(seed)
    pages = [read(made_page(rnd, long, short)) for _ in range(made_pages)]
    return fit(features(pages), np.concatenate([labelled(p) for p in pages]))


def extract(sources: Sequence[str], model: BoostedTrees) -> list[str]:
    """The blocks of the nodes kept, in page order, an empty line between two."""
    pages = [read(s) for s in sources]
    if not pages:
        return []
    odds = model.margin(features(pages))
    out, at = [], 0
    for page in pages:
        kept = choose(page, odds[at : at + len(page.nodes)])
        at += len(page.nodes)
        out.append("\n\n".join(text for owner, text in page.blocks if kept[owner]))
    return out


def _extract_batches(batches: Iterator[pa.RecordBatch], model: BoostedTrees) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sources = [s or "" for s in batch.column(2).to_pylist()]
        low = 0
        while low < len(sources):
            high, chars = low, 0
            while high < len(sources) and (chars == 0 or chars + len(sources[high]) <= _BATCH_CHARS):
                chars, high = chars + len(sources[high]), high + 1
            made = extract(sources[low:high], model)
            part = batch.slice(low, high - low)
            arrays = [part.column(0), part.column(1), pa.array(made, pa.string()), pa.array([len(t) for t in made], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, ["page_id", "url", "text", "n_chars"])
            low = high


def training_sample(pages: DataFrame, n: int = TRAIN_PAGES, chars: int = TRAIN_CHARS) -> list[str]:
    """Sources of at most ``n`` pages with at most ``chars`` characters in all, by smallest hash of id and url.

    Pages ``(page_id, url, html)`` are taken in that order, and one that would go beyond ``chars`` is left
    out. Rows with one id and url count once. Only lengths are looked at before the choice.
    """
    lengths = pages.where("html IS NOT NULL").groupBy("page_id", "url").agg(F.min(F.length("html")).alias("n"))
    chosen, total = [], 0
    for r in hash_sample(lengths, ["page_id", "url"], n).collect():
        if total + r.n <= chars:
            chosen.append((r.page_id, r.url, r.n))
            total += r.n
    wanted = pages.sparkSession.createDataFrame(chosen, lengths.schema).withColumnsRenamed({"page_id": "_id", "url": "_url", "n": "_n"})
    # as many rows as the sample has
    same = F.col("page_id").eqNullSafe(F.col("_id")) & F.col("url").eqNullSafe(F.col("_url")) & (F.length("html") == F.col("_n"))
    return sorted(r.html for r in pages.join(F.broadcast(wanted), same).groupBy("page_id", "url").agg(F.min("html").alias("html")).collect())


def extract_text(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", source: str = "html",
    train_pages: int = TRAIN_PAGES, train_chars: int = TRAIN_CHARS,
) -> DataFrame:
    """``(page_id, url, text, n_chars)``, one row for each row of ``pages``.

    The model is fitted on the driver from at most ``train_pages`` pages with at most ``train_chars``
    characters, see ``training_sample``; if none of them fits, it is fitted on stock words, with a
    warning. A null source counts as empty and has the text ''; rows with null ids or urls and repeated
    rows are read like others; other columns are not carried. Pages are read whole, a batch of them at a
    time, however long.
    """
    base = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(source).alias("html"))
    sample = training_sample(base, train_pages, train_chars)
    if not sample:
        warnings.warn("no page fits into the training sample; the trees are fitted on stock words", stacklevel=2)
    kinds = {f.name: f.dataType.simpleString() for f in base.schema}
    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    return arrow_map(base, partial(_extract_batches, model=train(sample)), schema)
