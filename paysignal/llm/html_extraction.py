"""Main text of HTML pages by gradient-boosted trees over DOM nodes and a consistent choice of nodes.

Every block node and text leaf is described by its subtree's density, its
attribute tokens and those above it, its depth, place and siblings. Boosted trees
turn that into log-odds of belonging to the main text. A dynamic programme over the
tree then takes the most likely choice in which nothing below a rejected node is kept:
a rejected node costs its whole subtree, a kept one lets each child decide.

There are no labelled pages, so training pages are built: a bounded, hash-drawn sample of pages
with an ``article`` or ``main`` element gives real titles, paragraphs and surroundings;
these are put together again in many layouts, with and without telling element names and
attribute tokens, and with surroundings (menus, notices, sidebars, comments, forms, adverts, footers)
in varied places. In a built page the main text is known. Reading goes by the
trees alone; no element is taken for granted.

Cases: null, empty and text-free pages give empty text; repeated rows are treated alike; without any page
to learn from, texts of built-in filler blocks make the training pages; further columns are ignored.
"""

from __future__ import annotations

import html
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paysignal.llm.boosted_trees import BoostedTrees, fit_trees
from paysignal.llm.html_nodes import Page, read_page

SAMPLE_PAGES = 300
VARIANTS = 4

# Words in class, id and role attributes that commonly name parts of a page.
CONTENT_TOKENS = frozenset("article content main post entry story body text blog news".split())
OTHER_TOKENS = frozenset(
    "nav navbar navigation menu header masthead footer sidebar aside ad ads adv advert advertisement banner promo sponsor sponsored "
    "cookie cookies notice consent gdpr alert popup modal overlay comment comments disqus respond reply replies share sharing social related "
    "recommended newsletter subscribe signup form login search breadcrumb breadcrumbs pagination pager widget tags copyright "
    "legal toolbar skip complementary contentinfo feedback reviews discussion".split())
_TAG_GROUPS = {
    "article main": 0, "p": 1, "h1 h2 h3 h4 h5 h6 hgroup": 2, "li dt dd option": 3, "ul ol dl menu": 4, "div section body": 5,
    "table tbody thead tfoot tr td th caption": 6, "nav": 7, "header": 8, "footer address": 9, "aside": 10,
    "form fieldset button select legend": 11, "blockquote pre figure figcaption": 12}
_GROUP = {name: g for names, g in _TAG_GROUPS.items() for name in names.split()}
_LEAF, _OTHER = 13, 14
_ABOVE = (0, 7, 8, 9, 10, 11)  # groups that count when they stand above a node


def features(page: Page) -> np.ndarray:
    """One row per node and leaf."""
    n = len(page.tag)
    parent = page.parent
    chars, links, stops, leaves, nodes = ([0] * n for _ in range(5))
    longest = [0] * n
    for i in range(n):
        if not page.tag[i]:
            text = page.text[i]
            chars[i], links[i], leaves[i] = len(text), page.links[i], 1
            stops[i] = text.count(". ") + text.count(", ") + (text[-1:] in ".!?")
            longest[i] = len(text)
    for i in range(n - 1, 0, -1):
        p = parent[i]
        chars[p] += chars[i]
        links[p] += links[i]
        stops[p] += stops[i]
        leaves[p] += leaves[i]
        nodes[p] += nodes[i] + 1
        longest[p] = max(longest[p], longest[i])
    own_yes = [0] * n
    own_no = [0] * n
    above_yes, above_no, depth, before, index, siblings = ([0] * n for _ in range(6))
    above = [0] * n
    group = [0] * n
    seen = 0
    children = [0] * n
    last_child = [-1] * n
    previous = [-1] * n
    following = [-1] * n
    for i in range(n):
        group[i] = _GROUP.get(page.tag[i], _OTHER) if page.tag[i] else _LEAF
        for token in page.tokens[i]:
            own_yes[i] += token in CONTENT_TOKENS
            own_no[i] += token in OTHER_TOKENS
        p = parent[i]
        before[i] = seen
        if p >= 0:
            depth[i] = depth[p] + 1
            above_yes[i] = above_yes[p] + own_yes[p]
            above_no[i] = above_no[p] + own_no[p]
            above[i] = above[p] | (1 << group[p])
            index[i] = children[p]
            children[p] += 1
            if last_child[p] >= 0:
                previous[i] = last_child[p]
                following[last_child[p]] = i
            last_child[p] = i
        if not page.tag[i]:
            seen += chars[i]
    for i in range(1, n):
        siblings[i] = children[parent[i]]
    total = max(seen, 1)
    c = np.array(chars, dtype=np.float64)
    safe = np.maximum(c, 1.0)
    up = np.maximum(np.array(parent), 0)
    g = np.array(group)
    a = np.array(above)

    def beside(which: list[int]) -> np.ndarray:
        at = np.array(which)
        return np.where(at >= 0, np.log1p(c[at]), -1.0)

    columns = [
        np.log1p(c), c / (np.array(nodes) + 1.0), np.array(links) / safe, 100.0 * np.array(stops) / safe, c / total,
        np.array(leaves, dtype=np.float64), c / np.maximum(np.array(leaves), 1), np.array(longest, dtype=np.float64),
        np.array(depth, dtype=np.float64), np.array(before) / total, (total - np.array(before) - c) / total,
        np.array(index, dtype=np.float64), np.array(siblings, dtype=np.float64), c / np.maximum(c[up], 1.0),
        np.array(links)[up] / np.maximum(c[up], 1.0), c[up] / total, beside(previous), beside(following),
        np.minimum(own_yes, 3), np.minimum(own_no, 3), np.minimum(above_yes, 3), np.minimum(above_no, 3),
        *((g == k).astype(np.float64) for k in range(15)), *(((a >> k) & 1).astype(np.float64) for k in _ABOVE),
        *((g[up] == k).astype(np.float64) for k in (1, 2, 3, 6)),
    ]
    return np.column_stack([np.asarray(x, dtype=np.float64) for x in columns])


def choose(page: Page, log_odds: np.ndarray) -> list[bool]:
    """Most likely set of kept nodes that is closed upwards; the root is always kept."""
    n = len(page.tag)
    keep_cost = np.logaddexp(0, -log_odds).tolist()
    drop_cost = np.logaddexp(0, log_odds).tolist()
    dropped, kept = drop_cost[:], keep_cost[:]
    for i in range(n - 1, 0, -1):
        p = page.parent[i]
        dropped[p] += dropped[i]
        kept[p] += min(kept[i], dropped[i])
    taken = [True] * n
    for i in range(1, n):
        taken[i] = taken[page.parent[i]] and kept[i] <= dropped[i]
    return taken


def main_text(page: Page, log_odds: np.ndarray) -> str:
    taken = choose(page, log_odds)
    return "\n\n".join(t for t, tag, k in zip(page.text, page.tag, taken, strict=True) if k and not tag)


# --- training pages -------------------------------------------------------------------------------------------------


def pieces(page: Page) -> tuple[list[str], list[str], list[str]] | None:
    """Main blocks, link texts and other texts of a page that marks its main text by ``article`` or ``main``."""
    inside = [False] * len(page.tag)
    main: list[str] = []
    link_texts: list[str] = []
    other: list[str] = []
    for i, tag in enumerate(page.tag):
        p = page.parent[i]
        named = bool(OTHER_TOKENS & set(page.tokens[i])) or _GROUP.get(tag) in (7, 8, 9, 10, 11)
        inside[i] = not named and (tag in ("article", "main") or (p >= 0 and inside[p]))
        if not tag:
            if inside[i]:
                main.append(page.text[i])
            elif page.links[i] * 2 > len(page.text[i]):
                link_texts.append(page.text[i])
            else:
                other.append(page.text[i])
    return (main, link_texts, other) if main else None


_FILLER = (
    ["Title of the page", "A first paragraph that tells what happened, where it happened, and why anybody should care about it at all.",
     "A second paragraph, longer than a menu item, with commas, clauses and full stops. It goes on for a while. Then it ends.",
     "A short closing line."], ["Home", "About", "Contact", "News", "More"],
    ["All rights reserved by the site.", "Sponsored offer, only today.", "We use cookies on this site to make it work."])


def build_page(rng: random.Random, main: list[str], link_texts: list[str], other: list[str], strangers: list[str]) -> str:
    """A page of known main text, which is marked by ``data-keep`` on its blocks."""
    e = html.escape
    link_texts = link_texts or _FILLER[1]
    other = other or _FILLER[2]

    def words(text: str, n: int) -> str:
        return " ".join(text.split()[:n])

    def short(n: int = 14) -> str:
        return e(words(rng.choice(other + strangers), rng.randint(2, n)))

    def long() -> str:
        return e(words(rng.choice(strangers + other), rng.randint(10, 70)))

    def attr(token: str, always: bool = False) -> str:
        if not always and rng.random() < 0.35:
            return ""
        token = rng.choice([token, f"site-{token}", f"{token}-box", f"{token} block"])
        return rng.choice([f' class="{token}"', f' id="{token}"', f" class='{token}'"])

    def links(n: int) -> str:
        return "".join(f'<li><a href="/x">{e(words(rng.choice(link_texts + other), rng.randint(1, 5)))}</a></li>' for _ in range(n))

    def menu() -> str:
        tag = rng.choice(["nav", "div", "div"])
        return f"<{tag}{attr(rng.choice(['nav', 'menu', 'navigation']))}><ul>{links(rng.randint(3, 9))}</ul></{tag}>"

    def head() -> str:
        tag = rng.choice(["header", "div"])
        title = rng.choice([f"<h1>{short(4)}</h1>", f"<div>{short(4)}</div>", ""])
        return f"<{tag}{attr('header', tag == 'div')}>{title}{menu() if rng.random() < 0.5 else f'<p>{short()}</p>'}</{tag}>"

    def foot() -> str:
        tag = rng.choice(["footer", "div"])
        inner = rng.choice([f"&copy; {short()}", f"<p>&copy; {short()}</p>", f"<ul>{links(4)}</ul><p>{long()}</p>"])
        return f"<{tag}{attr('footer', tag == 'div' and rng.random() < 0.7)}>{inner}</{tag}>"

    def side() -> str:
        tag = rng.choice(["aside", "div", "section"])
        inner = rng.choice([f"<h3>{short(4)}</h3><ul>{links(5)}</ul>", f"<p>{long()}</p>", f"<h2>{short(5)}</h2><p>{long()}</p><p>{long()}</p>"])
        return f"<{tag}{attr(rng.choice(['sidebar', 'widget', 'related', 'recommended']), tag != 'aside')}>{inner}</{tag}>"

    def notice() -> str:
        name = rng.choice(["cookie", "notice", "consent", "alert", "banner", "popup", "gdpr"])
        inner = rng.choice([f"<p>{long()}</p>", short(), f"<p>{short()}</p><button>OK</button>"])
        return f"<{rng.choice(['div', 'section'])}{attr(name, True)}>{inner}</div>".replace("</div>", "</div></section>")

    def advert() -> str:
        tag = rng.choice(["div", "aside", "section", "p"])
        return f"<{tag}{attr(rng.choice(['ad', 'ads', 'advert', 'promo', 'sponsor', 'advertisement']), tag == 'p' or rng.random() < 0.8)}>{short(25)}</{tag}>"

    def comments() -> str:
        tag = rng.choice(["section", "div", "ol"])
        name = rng.choice(["comments", "comment-list", "disqus", "replies", "discussion"])
        one = lambda: rng.choice([
            f'<div class="comment"><b>{short(2)}</b><p>{long()}</p></div>', f"<p>{long()}</p>", f'<article class="comment"><p>{long()}</p></article>'])
        return f'<{tag} {rng.choice(["class", "id"])}="{name}"><h3>{short(3)}</h3>{"".join(one() for _ in range(rng.randint(1, 5)))}</{tag}>'

    def form() -> str:
        return f"<form{attr(rng.choice(['newsletter', 'search', 'subscribe', 'login']))}><p>{short()}</p><label>{short(3)}</label><input><button>{short(2)}</button></form>"

    def shares() -> str:
        return f"<{rng.choice(['div', 'ul'])}{attr(rng.choice(['share', 'social', 'breadcrumb', 'tags']), True)}>{links(4)}</div></ul>"

    blocks = []
    for k, text in enumerate(main):
        t = e(text)
        draw = rng.random()
        if k == 0 and len(text) < 200:
            blocks.append(f"<{(h := rng.choice(['h1', 'h1', 'h2']))} data-keep=1>{t}</{h}>")
        elif draw < 0.80:
            lead = f"<b>{words(t, 2)}</b>" if rng.random() < 0.2 and "&" not in t[:40] else None
            blocks.append(f"<p data-keep=1>{lead + t[len(words(t, 2)):] if lead else t}</p>")
        elif draw < 0.86:
            parts = t.split(". ")
            blocks.append("<ul data-keep=1>" + "".join(f"<li>{x}</li>" for x in parts if x) + "</ul>")
        elif draw < 0.90:
            blocks.append(f"<blockquote data-keep=1><p>{t}</p></blockquote>")
        elif draw < 0.94:
            blocks.append(f"<h2 data-keep=1>{words(t, 6) if '&' not in t else 'Part'}</h2><p data-keep=1>{t}</p>")
        elif draw < 0.97:
            blocks.append(f"<div data-keep=1>{t}</div>")
        else:
            blocks.append(f"<p data-keep=1>{t[:40].rsplit('&', 1)[0]} <a href='/y'>{short(3)}</a></p>")
        if rng.random() < 0.05:
            blocks.append(rng.choice([advert, side, form, shares])())
    inner = "".join(blocks)
    if rng.random() < 0.15:
        inner += rng.choice([comments, shares, form])()
    wrapper = rng.choice(["article", "article", "main", "token", "token", "div", "section", "td", "none", "both"])
    if wrapper in ("article", "main", "div", "section"):
        body = f"<{wrapper}>{inner}</{wrapper}>"
    elif wrapper == "token":
        body = f'<div {rng.choice(["class", "id"])}="{rng.choice(["content", "post", "entry-content", "main", "story", "article-body"])}">{inner}</div>'
    elif wrapper == "td":
        body = f"<table><tr><td>{side()}</td><td>{inner}</td></tr></table>"
    elif wrapper == "both":
        body = f"<main><div><article>{inner}</article>{side()}</div></main>"
    else:
        body = inner
    first = [f() for f in (head, menu, notice, advert, shares) if rng.random() < 0.4]
    last = [f() for f in (comments, side, form, notice, advert) if rng.random() < 0.35]
    rng.shuffle(first)
    rng.shuffle(last)
    page = "".join(first) + body + "".join(last) + (foot() if rng.random() < 0.8 else "")
    if rng.random() < 0.2:
        page = f"<div{attr('wrapper', True)}>{page}</div>"
    return f"<html><head><title>{e(main[0][:60])}</title></head><body>{page}</body></html>"


def labels_of(page: Page) -> np.ndarray:
    """Main text: marked blocks, all below them, and whatever contains some."""
    n = len(page.tag)
    yes = [False] * n
    for i in range(n):
        p = page.parent[i]
        yes[i] = page.keep[i] or (p >= 0 and yes[p])
    for i in range(n - 1, 0, -1):
        if yes[i]:
            yes[page.parent[i]] = True
    return np.array(yes)


def train_on(sources: list[str], variants: int = VARIANTS, seed: int = 9) -> BoostedTrees:
    rng = random.Random(seed)
    found = [p for s in sources if (p := pieces(read_page(s)))] or [tuple(list(x) for x in _FILLER)] * 20
    strangers = [t for main, _, other in found for t in (*main[1:3], *other)][:2000] or list(_FILLER[2])
    x, y = [], []
    for main, link_texts, other in found:
        for _ in range(variants):
            few = rng.random() < 0.25  # short main texts among the same surroundings
            part = [" ".join(t.split()[: rng.randint(3, 15)]) for t in main[: rng.randint(1, 3)]] if few else main[: rng.randint(2, 12)]
            page = read_page(build_page(rng, part, link_texts, other, strangers))
            x.append(features(page)[1:])
            y.append(labels_of(page)[1:])
    return fit_trees(np.concatenate(x), np.concatenate(y).astype(np.float64))


def train(pages: DataFrame, id_column: str = "page_id", html_column: str = "html", most: int = SAMPLE_PAGES) -> BoostedTrees:
    """Learns from at most ``most`` pages, those with the least hash of their id."""
    marked = pages.filter(F.col(html_column).rlike("(?i)<(article|main)[ >]"))
    n = marked.count()
    drawn = F.pmod(F.xxhash64(F.col(id_column), F.lit(42)), F.lit(1 << 20)) / float(1 << 20)
    near = marked.withColumn("_u", drawn).filter(F.col("_u") * n <= 2.0 * most + 50)
    rows = near.select("_u", F.col(id_column).cast("string").alias("_id"), F.col(html_column).alias("_html")).orderBy("_u", "_id", "_html").limit(most)
    return train_on([r._html for r in rows.collect()])


def extract(pages: DataFrame, model: BoostedTrees, html_column: str = "html") -> DataFrame:
    """``pages`` with ``text`` in place of the html column (an equally named column is replaced)."""
    plain = pages.drop(*({"text"} - {html_column}))
    names = [c for c in plain.columns if c != html_column]
    schema = T.StructType([*(plain.schema[c] for c in names), T.StructField("text", T.StringType())])
    sent = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: list[str] = []
            column = batch.column(len(names))
            for lo in range(0, batch.num_rows, 256):
                read = [read_page(s) for s in column.slice(lo, 256).to_pylist()]
                rows = [features(p) for p in read]
                odds = sent.value.log_odds(np.concatenate(rows))
                at = 0
                for page, own in zip(read, rows, strict=True):
                    texts.append(main_text(page, odds[at : at + len(own)]))
                    at += len(own)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=[*names, "text"])

    return plain.select(*names, html_column).mapInArrow(run, schema)
