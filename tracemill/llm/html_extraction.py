"""Main text of web pages through wrappers inferred per host.

The pages of a host come from the same templates. A wrapper is a regular expression without
unions over the blocks of such a page: a sequence of blocks and text slots, each required,
optional or repeated, nested like the page. It is inferred by aligning token streams:

1. inside a page, blocks that follow each other alike, alone or in groups of up to four, fold
   into one repeated group;
2. two streams are aligned by their longest common sequence of blocks; what only one of them
   has becomes optional, what stands in both is aligned inside, and two texts become one slot;
3. a sequence that grows beyond ``WIDE`` becomes one repeated group of optional blocks.

Pages of a host with the same folded stream enter the alignment once, with counts. The streams
of a host are aligned in groups of about ``FAN``, in a fixed order, and the resulting wrappers
again until one is left, so no task sees more than a bounded part of a host.

A slot of the wrapper is the article if no block around it is a menu, header, footer, sidebar,
notice, advert, form or comment by its tag or its words, if its text is not the same on the
pages of the host, and if it stands inside an article; hosts without one take the innermost
block that has most of the text that is not linked.

Defined cases: null or empty html gives an empty text; a null url is a host of its own;
repeated rows give one row each; broken markup is closed as browsers do; a host with a single
page has a wrapper of that page alone; an empty table gives an empty result; other columns
may have any name.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracemill.llm.common import table
from tracemill.llm.markup import Node, Page, Slot
from tracemill.session import materialise

#: Longest group that is looked for as a repetition.
PERIOD = 4
#: Blocks of one sequence, beyond which it becomes one repeated group.
WIDE = 48
#: Streams or wrappers that one task aligns at a time.
FAN = 64
#: Folded streams a task holds before it sends what it has counted.
HELD = 4096
#: A host with more than this share of all pages is dealt over parts of this size.
SHARE = 1024
#: The key of a group of optional blocks in any order.
ANY = "(*)"

#: Blocks whose name tells nothing about what they hold.
BARE = frozenset(["div", "section"])

# Words that name what is no article.
STRONG = frozenset("""ad ads adv advert adverts advertisement advertising adsense aside breadcrumb breadcrumbs comment comments consent
    cookie cookies disqus footer gdpr hidden login menu modal nav navbar navigation newsletter outbrain overlay pager pagination popup
    promo promotion recommended recommendations related replies reply respond share sharing sidebar signup sitemap skip social sponsor
    sponsored subscribe subscription taboola toolbar topbar widget
    role=navigation role=banner role=contentinfo role=complementary role=search role=form role=dialog role=alert role=menu""".split())
WEAK = frozenset("alert banner copyright feedback form header legal masthead notice notices search side".split())
TAGS = frozenset("nav footer aside form menu button select option dialog fieldset legend head search".split())
OWN = frozenset("article entry post story".split())


@lru_cache(maxsize=65_536)
def unwanted(key: str) -> bool:
    """Whether a block of this name is no part of an article, wherever it stands."""
    tag, *names = key.split(".")
    found = set(names)
    return tag in TAGS or bool(found & STRONG) or (bool(found & WEAK) and not found & OWN)


@lru_cache(maxsize=65_536)
def is_article(key: str) -> bool:
    tag, *names = key.split(".")
    return tag in ("article", "main") or "role=main" in names or "role=article" in names


def _merge_slots(a: Slot, b: Slot, same_page: bool) -> Slot:
    """Put what ``b`` holds into ``a``."""
    a.pages = max(a.pages, b.pages) if same_page else a.pages + b.pages
    a.chars += b.chars
    a.links += b.links
    a.low, a.high = min(a.low, b.low), max(a.high, b.high)
    a.runs += b.runs
    a.optional = a.optional or b.optional
    return a


def _merge(a, b, same_page: bool):
    """Put ``b`` into ``a``, which has the same key."""
    if isinstance(a, Slot):
        return _merge_slots(a, b, same_page)
    a.items = align(a.items, b.items, same_page)
    a.many, a.optional = a.many or b.many, a.optional or b.optional
    return a


def lined_up(a: list, b: list) -> list[tuple[int | None, int | None]]:
    """Pairs of places with equal keys, in order, as many as possible; the others alone."""
    start = 0
    while start < len(a) and start < len(b) and a[start].key == b[start].key:
        start += 1
    tail = 0
    while tail < min(len(a), len(b)) - start and a[-1 - tail].key == b[-1 - tail].key:
        tail += 1
    x, y = [i.key for i in a[start:len(a) - tail]], [i.key for i in b[start:len(b) - tail]]
    longest = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x) - 1, -1, -1):
        for j in range(len(y) - 1, -1, -1):
            longest[i][j] = longest[i + 1][j + 1] + 1 if x[i] == y[j] else max(longest[i + 1][j], longest[i][j + 1])
    out: list[tuple[int | None, int | None]] = [(i, i) for i in range(start)]
    i = j = 0
    while i < len(x) or j < len(y):
        if i < len(x) and j < len(y) and x[i] == y[j]:
            out.append((start + i, start + j))
            i, j = i + 1, j + 1
        elif j == len(y) or (i < len(x) and longest[i + 1][j] >= longest[i][j + 1]):
            out.append((start + i, None))
            i += 1
        else:
            out.append((None, start + j))
            j += 1
    return out + [(len(a) - t, len(b) - t) for t in range(tail, 0, -1)]


def _grouped_like(items: list, other: list) -> list:
    """``items`` with a group around each run of blocks that repeats in ``other``."""
    for group in other:
        if isinstance(group, Node) and group.key.startswith("(") and group.key != ANY:
            keys = [i.key for i in group.items]
            n = len(keys)
            for at in range(len(items) - n + 1):
                if [i.key for i in items[at:at + n]] == keys:
                    items = [*items[:at], Node(group.key, items[at:at + n]), *items[at + n:]]
                    break
    return items


def _bare(key: str) -> str:
    return key.split(".")[0]


def _one_group(items: list, same_page: bool) -> list:
    """The sequence as one repeated group of optional blocks, one of each key."""
    flat = []
    for item in items:
        flat += item.items if isinstance(item, Node) and item.key.startswith("(") else [item]
    for naming in (lambda k: k, _bare, lambda k: "#" if k == "#" else "*"):
        kinds: dict[str, Slot | Node] = {}
        for item in flat:
            key = naming(item.key)
            if isinstance(item, Node) and item.key != key:
                item = Node(key, item.items, item.many, item.optional)
            kinds[key] = _merge(kinds[key], item, same_page) if key in kinds else item
        if len(kinds) <= WIDE:
            break
    for item in kinds.values():
        item.optional = True
    return [Node(ANY, list(kinds.values()), many=True)]


def align(a: list, b: list, same_page: bool = False) -> list:
    """One sequence that covers both; what only one has is optional. Uses up its arguments."""
    if len(a) == len(b) == 1 and a[0].key == b[0].key != ANY:
        return [_merge(a[0], b[0], same_page)]
    if any(i.key == ANY for i in a) or any(i.key == ANY for i in b):
        return _one_group(a + b, same_page)
    a, b = _grouped_like(a, b), _grouped_like(b, a)
    out = []
    for i, j in lined_up(a, b):
        if i is not None and j is not None:
            out.append(_merge(a[i], b[j], same_page))
        else:
            only = a[i] if i is not None else b[j]
            only.optional = True
            out.append(only)
    return out if len(out) <= WIDE else _one_group(out, same_page)


def _alike(a, b) -> bool:
    """Whether two blocks may be rounds of one repetition; bare containers only if they hold the same."""
    if a.key != b.key or isinstance(a, Slot):
        return a.key == b.key
    inner, other = ({i.key for i in x.items if isinstance(i, Node)} for x in (a, b))
    return inner == other if a.key in BARE else not inner or not other or bool(inner & other)


def fold(items: list) -> list:
    """Fold the repetitions of one page's sequence, inner ones first. Uses up its argument."""
    for item in items:
        if isinstance(item, Node) and (len(item.items) > 1 or (item.items and isinstance(item.items[0], Node))):
            item.items = fold(item.items)
    for period in range(1, PERIOD + 1):
        if len({i.key for i in items}) == len(items):
            break
        out: list = []
        at = 0
        while at < len(items):
            if at + 2 * period > len(items) or items[at].key != items[at + period].key:
                out.append(items[at])
                at += 1
                continue
            first = items[at:at + period]
            end = at + period
            while end + period <= len(items) and all(
                    _alike(x, y) for x, y in zip(items[end - period:end], items[end:end + period])):
                end += period
            if end == at + period or (period > 1 and all(i.key == first[0].key for i in first)):
                out.append(items[at])
                at += 1
                continue
            round_ = first
            for start in range(at + period, end, period):
                round_ = [_merge(x, y, True) for x, y in zip(round_, items[start:start + period])]
            if period == 1:
                if isinstance(round_[0], Node):
                    round_[0].many = True
                out.append(round_[0])
            else:
                out.append(Node("(" + " ".join(i.key for i in round_) + ")", round_, many=True))
            at = end
        items = out
    return items if len(items) <= WIDE else _one_group(items, True)


def slots(items: list, path: tuple = ()) -> Iterator[tuple[tuple, Slot]]:
    """All slots in order with the names of the blocks around them."""
    for item in items:
        if isinstance(item, Slot):
            yield path, item
        else:
            yield from slots(item.items, (*path, item.key))


def packed(items: list, counts: bool) -> list:
    """A sequence as lists for JSON, with or without what was counted."""
    return [([i.pages, i.chars, i.links, i.low, i.high, i.optional] if counts else 0) if isinstance(i, Slot)
            else [i.key, i.many, i.optional, packed(i.items, counts)] for i in items]


def unpacked(items: list) -> list:
    out = []
    for item in items:
        if item == 0:
            out.append(Slot())
        elif isinstance(item[0], str):
            out.append(Node(item[0], unpacked(item[3]), item[1], item[2]))
        else:
            slot = Slot(*item[:5])
            slot.optional = item[5]
            out.append(slot)
    return out


def shown(items: list) -> str:
    """A wrapper as a regular expression over blocks, for people."""
    def one(item) -> str:
        body = "#" if isinstance(item, Slot) else (
            "(" + shown(item.items) + ")" if item.key.startswith("(") else item.key + ("(" + shown(item.items) + ")" if item.items else ""))
        many = not isinstance(item, Slot) and item.many
        return body + ("*" if many and item.optional else "+" if many else "?" if item.optional else "")

    return " ".join(one(i) for i in items)


def _placed(items: list, names: tuple = (), places: tuple = ()) -> Iterator[tuple[tuple, tuple, Slot]]:
    """All slots with the names of the blocks around them and the places of those blocks."""
    for place, item in enumerate(items):
        if isinstance(item, Slot):
            yield names, places, item
        else:
            yield from _placed(item.items, (*names, item.key), (*places, place))


def decisions(wrapper: list) -> dict[int, bool]:
    """Which slots of a host's wrapper are article, by the identity of the slot."""
    every = list(_placed(wrapper))
    pages = max((s.pages for _, _, s in every), default=0)
    free = [(names, places, s) for names, places, s in every if not _dropped(names)]
    prose = sum(s.chars - s.links for _, _, s in free)
    same = {id(s): s.chars - s.links for _, _, s in free if s.pages >= 5 and 2 * s.pages >= pages and s.low == s.high}
    if 2 * sum(same.values()) >= prose:
        same = {}  # pages alike in most of their text tell nothing about templates
    inside = [(names, s) for names, _, s in free if any(is_article(k) for k in names)]
    if inside and 10 * sum(s.chars - s.links for _, s in inside) >= 3 * prose:
        chosen = [s for names, s in inside if not ("li" in {_bare(k) for k in names} and 10 * s.links >= 9 * s.chars)]
    else:
        unlinked = [(places, s) for _, places, s in free if 2 * s.links < s.chars]
        within = _innermost([(places, s.chars) for places, s in unlinked if id(s) not in same])
        chosen = [s for places, s in unlinked if places[:len(within)] == within]
    keep = {id(s) for s in chosen} - set(same)
    return {id(s): id(s) in keep for _, _, s in every}


def _innermost(texts: list[tuple[tuple, int]]) -> tuple:
    """The place of the innermost block that has nine tenths of the text and is more than one paragraph."""
    place: tuple = ()
    mass = sum(chars for _, chars in texts)
    while True:
        below: dict[tuple, int] = {}
        for places, chars in texts:
            if len(places) > len(place) and places[:len(place)] == place:
                step = places[:len(place) + 1]
                below[step] = below.get(step, 0) + chars
        best = max(below, key=lambda p: (below[p], p), default=None)
        if best is None or 10 * below[best] < 9 * mass or not any(len(p) > len(best) and p[:len(best)] == best for p, _ in texts):
            return place
        place = best


def _dropped(path: tuple) -> bool:
    owned = False
    for key in path:
        if unwanted(key) or (_bare(key) == "header" and not owned):
            return True
        owned = owned or is_article(key)
    return False


def matched(wrapper: list, items: list) -> Iterator[tuple[Slot | None, Slot, tuple]]:
    """Each slot of a page's folded stream with the wrapper's slot it stands for, if any."""
    def rest(item, path):
        if isinstance(item, Slot):
            yield None, item, path
        else:
            for inner in item.items:
                yield from rest(inner, (*path, item.key))

    def walk(a, b, path):
        if any(i.key == ANY for i in a):
            flat = []
            for item in b:
                flat += item.items if isinstance(item, Node) and item.key.startswith("(") else [item]
            kinds = {i.key: i for group in a for i in (group.items if isinstance(group, Node) and group.key.startswith("(") else [group])}
            pairs = [(kinds.get(i.key) or kinds.get(_bare(i.key)) or (kinds.get("*") if isinstance(i, Node) else None), i) for i in flat]
        else:
            b = _grouped_like(b, a)
            a = _grouped_like(a, b)
            pairs = [(None if i is None else a[i], b[j]) for i, j in lined_up(a, b) if j is not None]
        for mine, item in pairs:
            if mine is None:
                yield from rest(item, path)
            elif isinstance(item, Slot):
                yield mine, item, path
            else:
                yield from walk(mine.items, item.items, (*path, item.key))

    yield from walk(wrapper, items, ())


def _streams(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Folded streams of a task's pages by host, with what their slots hold."""
    held: dict[tuple[str, str], list] = {}

    def sent():
        rows = [(host, stream, seen[0], [s.chars for s in seen[1]], [s.links for s in seen[1]], [s.low for s in seen[1]], [s.high for s in seen[1]])
                for (host, stream), seen in held.items()]
        return pd.DataFrame(rows, columns=["host", "stream", "pages", "chars", "links", "low", "high"])

    for frame in frames:
        for host, html in zip(frame["host"], frame["html"]):
            items = fold(Page(html, unwanted).root.items)
            mine = [s for _, s in slots(items)]
            if not mine:
                continue
            key = host, json.dumps(packed(items, False), separators=(",", ":"), ensure_ascii=False)
            if key in held:
                seen = held[key]
                seen[0] += 1
                for a, b in zip(seen[1], mine):
                    b.runs = []
                    _merge_slots(a, b, True)
            else:
                for slot in mine:
                    slot.runs = []
                held[key] = [1, mine]
            if len(held) >= HELD:
                yield sent()
                held.clear()
    yield sent()


def streams(pages: DataFrame) -> DataFrame:
    """One row per host and distinct folded stream: ``host, stream, pages, facts`` of each slot."""
    kinds = "host string, stream string, pages long, chars array<long>, links array<long>, low array<long>, high array<long>"
    parts = pages.mapInPandas(_streams, kinds)
    each = parts.select("host", "stream", "pages", F.posexplode(F.arrays_zip("chars", "links", "low", "high")).alias("pos", "s"))
    merged = each.groupBy("host", "stream", "pos").agg(
        F.sum("pages").alias("pages"), F.sum("s.chars").alias("chars"), F.sum("s.links").alias("links"),
        F.min("s.low").alias("low"), F.max("s.high").alias("high"))
    return merged.groupBy("host", "stream").agg(
        F.max("pages").alias("pages"), F.array_sort(F.collect_list(F.struct("pos", "pages", "chars", "links", "low", "high"))).alias("facts"))


def _with_facts(stream: str, facts) -> list:
    items = unpacked(json.loads(stream))
    for (_, slot), fact in zip(slots(items), facts):
        slot.pages, slot.chars, slot.links, slot.low, slot.high = (fact[n] for n in ("pages", "chars", "links", "low", "high"))
    return items


def _as_wrappers(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        yield pd.DataFrame({"host": frame["host"], "pages": frame["pages"], "wrapper": [
            json.dumps(packed(_with_facts(s, f), True), separators=(",", ":"), ensure_ascii=False) for s, f in zip(frame["stream"], frame["facts"])]})


def _aligned(frame: pd.DataFrame) -> pd.DataFrame:
    """The wrapper of one group; the streams enter in the order of their texts."""
    rows = sorted(frame["wrapper"])
    wrapper = unpacked(json.loads(rows[0]))
    for row in rows[1:]:
        wrapper = align(wrapper, unpacked(json.loads(row)))
    text = json.dumps(packed(wrapper, True), separators=(",", ":"), ensure_ascii=False)
    return pd.DataFrame({"host": [frame["host"].iloc[0]], "pages": [int(frame["pages"].sum())], "wrapper": [text]})


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, pages, wrapper): one row per host, from ``pages`` (host, html)."""
    found = materialise(streams(pages).mapInPandas(_as_wrappers, "host string, pages long, wrapper string"))
    while True:
        counts = found.groupBy("host").agg(F.count(F.lit(1)).alias("n"))
        most = counts.agg(F.max("n")).first()[0] or 0
        if most <= 1:
            return found
        several = counts.filter(F.col("n") > 1).withColumn("groups", F.ceil(F.col("n") / FAN))
        dealt = found.join(several, "host").withColumn("group", F.pmod(F.xxhash64("wrapper"), F.col("groups")))
        merged = dealt.select("host", "pages", "wrapper", "group").groupBy("host", "group").applyInPandas(
            lambda frame: _aligned(frame), "host string, pages long, wrapper string")
        alone = found.join(counts.filter(F.col("n") == 1).select("host"), "host")
        found = materialise(merged.unionByName(alone.select("host", "pages", "wrapper")))


class Extractor:
    """Applies wrappers; remembers the wrappers of a few hosts and the streams seen of each."""

    def __init__(self):
        self._host = lru_cache(maxsize=256)(self._load)

    @staticmethod
    def _load(text: str):
        wrapper = unpacked(json.loads(text))
        return wrapper, decisions(wrapper), {}

    def __call__(self, html: str, text: str | None) -> str:
        page = Page(html, unwanted)
        if not page.texts:
            return ""
        items = fold(page.root.items)
        wrapper, keep, seen = self._host(text if text is not None else json.dumps(packed(items, True)))
        stream = json.dumps(packed(items, False), separators=(",", ":"), ensure_ascii=False)
        if stream not in seen:
            # slots come from the page's own tree, so they are found again by their place in it
            places = {id(s): n for n, (_, s) in enumerate(slots(items))}
            choice = [False] * len(places)
            for mine, slot, path in matched(wrapper, items):
                choice[places[id(slot)]] = keep[id(mine)] if mine is not None else (
                    not _dropped(path) and any(is_article(k) for k in path))
            if len(seen) > HELD:
                seen.clear()
            seen[stream] = choice
        runs = [run for chosen, (_, slot) in zip(seen[stream], slots(items)) if chosen for run in slot.runs]
        return "\n\n".join(page.texts[run] for run in sorted(runs))


def _extracted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    extract = Extractor()
    for frame in frames:
        texts = [extract(html, None if pd.isna(wrapper) else wrapper) for html, wrapper in zip(frame["html"], frame["wrapper"])]
        yield pd.DataFrame({"page_id": frame["page_id"], "url": frame["url"], "text": texts, "n_chars": [len(t) for t in texts]})


def host_of(url):
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1), F.lit(""))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars): the main text of every page."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), host_of(F.col(url_col)).alias("host"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    found = wrappers(rows.select("host", "html"))
    total = found.agg(F.sum("pages")).first()[0] or 0
    # at most SHARE hosts have more than that share, so this table is small at any size
    heavy = found.filter(F.col("pages") * SHARE > total).select("host", F.ceil(F.col("pages") * SHARE / F.lit(max(total, 1))).alias("parts"))
    salt = F.coalesce(F.pmod(F.xxhash64("page_id", "url"), F.col("parts")), F.lit(0))
    dealt = rows.join(F.broadcast(heavy), "host", "left").withColumn("salt", salt).drop("parts")
    copies = found.join(F.broadcast(heavy), "host", "left").select(
        "host", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("parts"), F.lit(1)) - 1)).alias("salt"), "wrapper")
    joined = dealt.join(copies, ["host", "salt"], "left").select("page_id", "url", "html", "wrapper")
    return joined.mapInPandas(_extracted, f"page_id {rows.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long")


def op11_html_extraction(spark, sf_dir):
    return extract(table(spark, sf_dir, "pages"))
