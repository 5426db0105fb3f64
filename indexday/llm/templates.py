"""Main text of web pages by deducing each host's template from equivalence classes of tokens."""

from __future__ import annotations

import json
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from indexday.llm.common import prepared
from indexday.llm.markup import CONTENT, INLINE, LISTS, Piece, clean, pieces
from indexday.operators.sizing import broadcast_if_small

MIN_PAGES = 8
MIN_SHARE = 0.5
LABEL_WORDS = 12
KEPT_SHARE = 0.9
POOL = "*"
POOL_PAGES = 100_000
HELD_COUNTS = 1_000_000
LOW = (1 << 32) - 1


def host(url: str) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _text_roles(piece: Piece) -> list[str]:
    words = piece.name.split()
    if len(words) <= LABEL_WORDS:
        return [f"{piece.path}|{w}" for w in words]
    return [f"{piece.path}|#{xxhash.xxh3_64_hexdigest(piece.name.strip())}"]


def _tokens(page: str) -> Iterator[tuple[str, Piece]]:
    """The tokens of a page with their roles: tags and words in their containers; a long text is one token."""
    for piece in pieces(page):
        if piece.kind != "text":
            yield piece.role, piece
        else:
            for role in _text_roles(piece):
                yield role, piece


def _page_hash(page: str) -> int:
    return xxhash.xxh3_64_intdigest(page)


def _role_hash(role: str) -> int:
    return xxhash.xxh3_64_intdigest(role) - (1 << 63)


def _counts_here(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages of this task per group and hash of a token."""
    counts: dict[str, Counter] = defaultdict(Counter)

    def flush():
        columns = [
            pa.array([g for g, own in counts.items() for _ in own], pa.string()),
            *[pa.array([x[i] for own in counts.values() for x in own.items()], pa.int64()) for i in (0, 1)],
        ]
        counts.clear()
        return pa.RecordBatch.from_arrays(columns, ["group", "role", "n"])

    for batch in batches:
        for group, page in zip(batch.column("group").to_pylist(), batch.column("html").to_pylist(), strict=True):
            counts[group].update({_role_hash(role) for role, _ in _tokens(page or "")})
        if sum(map(len, counts.values())) > HELD_COUNTS:
            yield flush()
    yield flush()


class _Known:
    """Parsed per-host information, which rows repeat."""

    def __init__(self):
        self.text, self.value = None, None

    def __call__(self, text: str | None):
        if text != self.text:
            self.text, self.value = text, json.loads(text) if text else None
        return self.value


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per group and token: its pages and a sum over pages of hash(page, occurrences), which stands for its occurrence vector."""
    sums: dict[tuple[str, str], list[int]] = {}
    pages: Counter = Counter()
    known = {}
    for batch in batches:
        for group, roles, page in zip(*[batch.column(c).to_pylist() for c in ("group", "roles", "html")], strict=True):
            if group not in known:
                known[group] = frozenset(roles or ())
            page = page or ""
            key = _page_hash(page)
            pages[group] += 1
            counts = Counter(r for r, _ in _tokens(page) if _role_hash(r) in known[group])
            for role, n in counts.items():
                own = sums.setdefault((group, role), [0, 0, 0, 0])
                h = xxhash.xxh3_64_intdigest(n.to_bytes(8, "little"), key)
                own[0] += 1
                own[1] += h & LOW
                own[2] += h >> 32
                own[3] = max(own[3], n)
    rows = [(g, r, *v) for (g, r), v in sums.items()] + [(g, None, n, 0, 0, 0) for g, n in pages.items()]
    types = [pa.string(), pa.string()] + [pa.int64()] * 4
    yield pa.RecordBatch.from_arrays(
        [pa.array([x[i] for x in rows], t) for i, t in enumerate(types)], ["group", "role", "pages", "v1", "v2", "most"]
    )


def _order_and_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a page shows of its group's classes.

    ``class``: the order of its tokens (empty if their occurrences do not take turns) and the slot of the root
    class they lie in (empty if several); a slot begins at a tag of the root. ``slot``: the characters of text in a root slot and its container.
    """
    found: dict[tuple, list[int]] = {}
    known = _Known()
    for batch in batches:
        for group, info, page in zip(*[batch.column(c).to_pylist() for c in ("group", "classes", "html")], strict=True):
            classes = known(info)
            if not classes:
                continue
            of = {role: i for i, c in enumerate(classes) for role in c}
            root, slot = frozenset(classes[0]), ""
            seen: dict[int, list[str]] = defaultdict(list)
            slots: dict[int, set[str]] = defaultdict(set)
            text: dict[tuple[str, str, bool], int] = defaultdict(int)
            last = None
            for role, piece in _tokens(page or ""):
                i = of.get(role)
                if i is not None:
                    seen[i].append(role)
                    slots[i].add(slot)
                    if role in root and piece.kind != "text":
                        slot = role
                if piece.kind == "text" and piece is not last:
                    text[slot, piece.path, piece.cut] += len(piece.name.strip())
                last = piece
            for i, roles in seen.items():
                m = len(classes[i])
                turn = roles[:m]
                regular = len(set(turn)) == m and roles == turn * (len(roles) // m)
                where = next(iter(slots[i])) if len(slots[i]) == 1 else ""
                key = (group, "class", i, json.dumps(turn) if regular else "", where, False)
                found.setdefault(key, [0, 0])[0] += 1
            for (at, path, cut), size in text.items():
                own = found.setdefault((group, "slot", 0, at, path, cut), [0, 0])
                own[0] += 1
                own[1] += size
    rows = [(*k, *v) for k, v in found.items()]
    types = [pa.string(), pa.string(), pa.int32(), pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.int64()]
    names = ["group", "kind", "class", "a", "b", "cut", "pages", "chars"]
    yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in rows], t) for i, t in enumerate(types)], names)


def _within(path: str, container: str) -> bool:
    return path == container or path.startswith(container + "/")


def _content_path(path: str) -> str:
    """The path down to its first article or main, or nothing."""
    parts = path.split("/")
    at = next((i for i, p in enumerate(parts) if p.split(".")[0] in CONTENT), None)
    return "/".join(parts[: at + 1]) if at is not None else ""


def _container(texts: list[tuple[str, bool, int]]) -> str | None:
    """Where the article is, by the text outside boilerplate: the article or main element with the most, else the
    smallest container of nearly all, reached by going down from the top while a container has no text of its own
    and one child, no list or table, keeps nine tenths of what it holds."""
    content, own, whole = Counter(), Counter(), Counter()
    children: dict[str, set[str]] = defaultdict(set)
    for path, cut, size in texts:
        if not cut and size:
            content[_content_path(path)] += size
            own[path] += size
            parts = path.split("/")
            for i in range(len(parts)):
                at = "/".join(parts[: i + 1])
                whole[at] += size
                if i:
                    children["/".join(parts[:i])].add(at)
    content.pop("", None)
    if content:
        return min(content, key=lambda p: (-content[p], p))
    if not whole:
        return None
    at = ""
    while not own[at]:
        best = min(children[at], key=lambda p: (-whole[p], p))
        if whole[best] < KEPT_SHARE * whole[at] or best.split("/")[-1].split(".")[0] in LISTS:
            break
        at = best
    return at


def _blocks(page: str, template: dict | None) -> list[str]:
    """The text blocks of a page in the template's article slots; without a match the page stands for itself.

    Text that belongs to the template is left out, unless that would leave less than half of the page's: then the host's pages
    are much the same, and what they have in common is no sign of a template.
    """
    parts = list(pieces(page))

    def written(p: Piece, fixed: frozenset) -> bool:
        """Whether all of a text is the template's own; what varies with the page is not."""
        roles = _text_roles(p)
        return bool(roles) and all(r in fixed for r in roles)

    def take(container: str | None, order: dict[str, int], slots: frozenset, fixed: frozenset) -> list[str]:
        blocks, held, at, slot = [], [], -1, ""
        gone: set[int] = set()
        if fixed and container is not None:
            inside = [p for p in parts if p.kind == "text" and not p.cut and _within(p.path, container)]
            gone = {id(p) for p in inside if written(p, fixed)}
            if 2 * sum(len(p.name.strip()) for p in inside if id(p) in gone) > sum(len(p.name.strip()) for p in inside):
                gone = set()

        def close():
            if block := clean("".join(held)):
                blocks.append(block)
            held.clear()

        for p in parts:
            if p.kind == "text":
                if id(p) not in gone and not p.cut and container is not None and _within(p.path, container) and (not order or slot in slots):
                    held.append(p.name)
                continue
            place = order.get(p.role, -1)
            if place > at:
                at, slot = place, p.role
            if p.name not in INLINE:
                close()
            elif p.name == "br":
                held.append(" ")
        close()
        return blocks

    if template:
        order = {r: i for i, r in enumerate(template["order"])}
        if blocks := take(template["container"], order, frozenset(template["slots"]), frozenset(template["fixed"])):
            return blocks
    own = _container([(p.path, p.cut, len(p.name.strip())) for p in parts if p.kind == "text"])
    return take(own, {}, frozenset(), frozenset())


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = _Known()
    for batch in batches:
        texts = ["\n".join(_blocks(page or "", known(info)))
                 for info, page in zip(batch.column("template").to_pylist(), batch.column("html").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
            ["page_id", "url", "text", "n_chars"],
        )


def _templates(rows: list[dict], sizes: dict[int, int], whole: set[int]) -> dict | None:
    """A group's template from what its pages showed.

    ``fixed`` are the words and texts in valid classes that are on all of the group's pages (``whole``): the template's own text,
    wherever it stands. It has no place in a slot, and the container of the article is sought without it.
    """
    shown: dict[int, Counter] = defaultdict(Counter)
    where: dict[int, set[str]] = defaultdict(set)
    texts, slot_paths = [], defaultdict(Counter)
    for r in rows:
        if r["kind"] == "class":
            shown[r["class"]][r["a"]] += r["pages"]
            where[r["class"]].add(r["b"])
        else:
            texts.append((r["b"], r["cut"], r["chars"]))
            slot_paths[r["a"]][r["b"], r["cut"]] += r["chars"]
    valid = {i: next(iter(c)) for i, c in shown.items() if len(c) == 1 and next(iter(c)) and c.total() == sizes.get(i)}
    fixed = sorted({role for i, turn in valid.items() if i in whole for role in json.loads(turn) if "|" in role})
    container = _container(texts)
    if 0 not in valid or container is None:
        return None
    order = json.loads(valid[0])
    slots = [s for s in ["", *order] if any(not cut and n and _within(p, container) for (p, cut), n in slot_paths[s].items())]
    nested = {next(iter(where[i])): json.loads(t) for i, t in valid.items() if i and len(where[i]) == 1 and "" not in where[i]}
    return {"order": order, "container": container, "slots": slots, "nested": nested, "fixed": fixed}


def _by_group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for rows, sizes, whole in zip(*[batch.column(c).to_pylist() for c in ("rows", "sizes", "whole")], strict=True):
            template = _templates(rows, dict(enumerate(sizes)), {i for i, w in enumerate(whole) if w})
            out.append(json.dumps(template) if template else None)
        yield pa.RecordBatch.from_arrays([batch.column("group"), pa.array(out, pa.string())], ["group", "template"])


def deduce(pages: DataFrame) -> DataFrame:
    """(host, template): for each host the template of its pages.

    Tokens are tags and words with the containers they stand in. Those on half of a host's pages at least are
    counted again on all pages: tokens with equal occurrence vectors form an equivalence class. A class is
    valid if its tokens take turns in one order on all pages; the class on most pages with most tokens, each
    once a page, is the root, and classes that stay in one of the root's slots nest there. The slots with text
    inside the article's container are the ones to extract, and the words and texts of valid classes that are on all pages
    are the template's own, which no slot keeps. Hosts of fewer than 8 pages share groups of about
    100,000 pages.

    All counts are sums added up before they are shuffled, so a host with most pages costs no more than another;
    tokens are gathered, as hashes, only once their pages are known to be half of the group's, so what is gathered
    per group is bounded by two pages.
    """
    store = prepared(pages.sparkSession)
    pages = pages.select(host("url").alias("host"), F.col("html").cast("string").alias("html"))
    counts = store.put("host_counts", pages.groupBy("host").agg(F.count("*").alias("n")))
    small = counts.filter(F.col("n") < MIN_PAGES).agg(F.sum("n")).first()[0] or 0
    pool = F.concat(F.lit(POOL), F.pmod(F.xxhash64("host"), F.lit(1 + small // POOL_PAGES)).cast("string"))
    hosts = counts.select("host", F.when(F.col("n") < MIN_PAGES, pool).otherwise(F.col("host")).alias("group"))
    hosts = store.put("hosts", hosts)
    grouped = pages.join(broadcast_if_small(hosts), "host").select("group", "html")
    frequent = grouped.mapInArrow(_counts_here, "group string, role long, n long").groupBy("group", "role").agg(F.sum("n").alias("n"))
    sizes = counts.join(hosts, "host").groupBy("group").agg(F.sum(counts["n"]).alias("total"))
    frequent = frequent.join(broadcast_if_small(sizes), "group").filter(F.col("n") >= MIN_SHARE * F.col("total"))
    roles = frequent.groupBy("group").agg(F.collect_list("role").alias("roles"))
    roles = store.put("roles", hosts.join(roles, "group", "left"))

    counted = pages.join(roles, "host").select("group", "roles", "html")
    counted = counted.mapInArrow(_vectors, "group string, role string, pages long, v1 long, v2 long, most long")
    counted = counted.groupBy("group", "role").agg(
        *[F.sum(c).alias(c) for c in ("pages", "v1", "v2")], F.max("most").alias("most")
    )
    counted = store.put("vectors", counted)
    totals = counted.filter("role IS NULL").select("group", F.col("pages").alias("total"))
    classes = (
        counted.filter("role IS NOT NULL").join(totals, "group").filter(F.col("pages") >= MIN_SHARE * F.col("total"))
        .groupBy("group", "pages", "v1", "v2", "total")
        .agg(F.sort_array(F.collect_list("role")).alias("roles"), F.max("most").alias("most"))
        .filter(F.size("roles") > 1)
    )
    rank = Window.partitionBy("group").orderBy(F.col("most") > 1, F.desc("pages"), F.desc(F.size("roles")), "v1", "v2")
    ranked = classes.withColumn("at", F.row_number().over(rank))
    ranked = ranked.groupBy("group").agg(F.sort_array(F.collect_list(F.struct("at", "roles", "pages", "total"))).alias("c"))
    ranked = ranked.select(
        "group",
        F.to_json(F.transform("c", lambda x: x["roles"])).alias("classes"),
        F.transform("c", lambda x: x["pages"]).alias("sizes"),
        F.transform("c", lambda x: x["pages"] == x["total"]).alias("whole"),
    )
    ranked = store.put("classes", ranked)

    shown = pages.join(store.put("host_classes", hosts.join(ranked, "group").drop("sizes", "whole")), "host")
    shown = shown.select("group", "classes", "html").mapInArrow(
        _order_and_slots, "group string, kind string, class int, a string, b string, cut boolean, pages long, chars long"
    )
    shown = shown.groupBy("group", "kind", "class", "a", "b", "cut").agg(F.sum("pages").alias("pages"), F.sum("chars").alias("chars"))
    line = F.struct("kind", "class", "a", "b", "cut", "pages", "chars")
    per_group = shown.groupBy("group").agg(F.sort_array(F.collect_list(line)).alias("rows")).join(ranked.drop("classes"), "group")
    # copies of a few pages have all their text in common, which is no template
    different = grouped.select("group", F.xxhash64("html").alias("page")).distinct().groupBy("group").agg(F.count("*").alias("n"))
    several = F.coalesce(F.col("n") >= MIN_PAGES, F.lit(False))
    per_group = per_group.join(broadcast_if_small(different), "group", "left")
    per_group = per_group.withColumn("whole", F.when(several, F.col("whole")).otherwise(F.array().cast("array<boolean>")))
    made = per_group.select("group", "rows", "sizes", "whole").mapInArrow(_by_group, "group string, template string")
    return store.put("templates", hosts.join(made, "group", "left").select("host", "template"))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars): the main text of every page, by its host's template (:func:`deduce`).

    Boilerplate inside a slot (navigation, page headers, footers, asides, forms, and what class, id or role call
    an advert, a notice, a sidebar, reader comments and the like) is skipped; html, body, main and article are never
    boilerplate by such a word, nor is what has the word behind a modifier (has-sidebar). Without an article or main
    element the text is that of the smallest container that holds nearly all. Character references are
    decoded, white space in a block is one space, blocks are joined in page order by a line feed; a line break
    element is white space. A page on which the template finds nothing is read by its own structure.

    Null and empty pages give an empty text, as do pages without text. A null or strange url belongs to the
    host ''. Repeated rows give a row each; other columns are not read. An empty table gives no rows.
    """
    templates = deduce(pages)
    prepared(pages.sparkSession)
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"), host("url").alias("_host"))
    joined = rows.join(templates.withColumnRenamed("host", "_host"), "_host", "left")
    kinds = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in ("page_id", "url"))
    return joined.select("page_id", "url", "html", "template").mapInArrow(_extract, f"{kinds}, text string, n_chars long")
