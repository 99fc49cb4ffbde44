"""Main text of web pages by equivalence classes of template tokens.

Pages of one host come from one template. A page is read as tokens, tags and
text blocks with the path of elements they stand in. Tokens that occur
equally often on every page (the same occurrence vector) form an equivalence
class; a class is valid if its tokens keep one order on all pages, and if it
nests: its occurrences lie between the same tokens of the classes around it.
Valid classes make the template (Arasu, Garcia-Molina 2003). What stands
between their tokens are the slots; a page's main text are its slots inside
the article, without those of menus, notices and the like.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from roadpulse.llm.common import materialize
from roadpulse.llm.registry import query, table

CHUNK = 128            # pages of a host that are read together at most
CHUNK_BYTES = 16 << 20  # and their bytes, about
FEW_HOSTS = 100_000    # so many large hosts, of a few bytes each, go to every task
SUPPORT = 0.6          # share of the pages a template class occurs on
LEAST_PAGES = 6        # different pages that text must recur on to be template

# Elements whose content is no markup, up to their end tag.
RAW = "script|style|noscript|textarea|template|iframe|title"
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{RAW})\b(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>?.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)(?:>|(?=<)|\Z)"
    r"|</?[a-zA-Z][^<>]*(?:>|(?=<)|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)", re.S | re.I)
ATTRIBUTE = re.compile(r"([^\s=/<>\"'][^\s=/<>]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small "
                   "span strike strong sub sup time tt u var wbr img svg math".split())
FOREIGN = frozenset("svg math".split())   # in these, <x/> is empty and all is inline
CLOSED_BY_SAME = frozenset("p li dt dd option tr td th".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# Elements, roles and names that mark what is not main text. A class or id is
# such a name as a whole: words of NAMES, alone or with those of PARTS, or a
# class that begins with one of PREFIXES.
ASIDE = frozenset("head nav footer aside form button input select dialog menu".split())
OPTIONS = frozenset("option optgroup hr".split())   # what an open select may hold
# Elements that label what follows them: recurring ones belong to the article
# if a slot follows.
LABELS = HEADINGS | frozenset("dt th caption figcaption summary legend".split())
# Elements that hold text rather than other elements; in an article only the
# names of notices and adverts set them apart.
TEXT_LEVEL = frozenset("p li blockquote pre td th dd dt figcaption".split())
NOTICES = frozenset("ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion cookie cookies "
                    "consent notice notices gdpr".split())
READERS = frozenset("reviews responses reactions".split())   # around nested articles
ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar "
                  "form".split())
NAMES = frozenset("ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion "
                  "sidebar aside menu nav navbar navigation breadcrumb breadcrumbs cookie cookies consent notice "
                  "notices alert gdpr popup modal overlay comment comments respond replies disqus footer share sharing "
                  "social related recommended newsletter subscribe signup login search widget toolbar "
                  "masthead pagination pager skip".split())
PARTS = frozenset("area bar block box button buttons container content form icons inner item items left links list "
                  "main outer page panel post posts primary right secondary section site slot top unit wrap "
                  "wrapper".split())
PREFIXES = ("adsbygoogle", "advertis", "breadcrumb", "disqus", "gdpr", "navbar", "sidebar")
SITE_NAMES = frozenset("header topbar".split())



def in_select(stack: list) -> bool:
    return any(s[0] == "select" for s in stack)


class Block:
    """A text block: its element path, whether it is set apart from the main
    text, whether an article or main element holds it, and how much of it is
    link text."""

    __slots__ = ("path", "apart", "main", "text", "linked")

    def __init__(self, path, apart, main, text, linked):
        self.path, self.apart, self.main, self.text, self.linked = path, apart, main, text, linked


def _apart(tag: str, rest: str, in_article: bool) -> tuple[bool, str]:
    """Whether an element is set apart, and its class name for the path."""
    if not rest:
        return tag in ASIDE or (tag == "header" and not in_article), ""
    label, apart = "", tag in ASIDE or (tag == "header" and not in_article)
    seen = set()
    for name, *values in ATTRIBUTE.findall(rest):
        name = name.lower()
        if name in seen:   # the first of a name counts
            continue
        seen.add(name)
        value = "".join(values).lower()
        if name == "role":
            apart |= not ROLES.isdisjoint(value.split())
        elif name == "hidden":
            apart = True
        elif name == "class":
            label = value
            apart |= any(v.startswith(PREFIXES) or _named_apart(v, in_article, tag) for v in value.split())
        elif name == "id" and tag not in HEADINGS:   # a heading's id is made of its text
            apart |= _named_apart(value, in_article, tag)
    return apart, label


def _named_apart(name: str, in_article: bool, tag: str) -> bool:
    words = {w for w in re.split(r"[^a-z]+", name) if w}
    if not in_article:
        marks = words & (NAMES | SITE_NAMES)
    elif tag in TEXT_LEVEL:
        marks = words & NOTICES
    else:
        marks = words & (NAMES | READERS)
    return bool(marks) and words <= marks | PARTS


def read_page(page: str) -> tuple[list[tuple], list[Block]]:
    """Tokens of a page in order, (path, None) for a tag and (path, text) for
    a text block, and the blocks. Unclosed elements end with the element
    around them."""
    tokens: list[tuple] = []
    blocks: list[Block] = []
    stack: list[tuple[str, str, bool, bool]] = [("", "", False, False)]   # tag, path, apart, in article or main
    text: list[str] = []
    linked, in_link = 0, 0

    def settle():
        nonlocal linked
        words = " ".join(html.unescape("".join(text)).split())
        if words:
            _, path, apart, main = block_at
            blocks.append(Block(path, apart, main, words, linked))
            tokens.append((path, words))
        text.clear()
        linked = 0

    def say(piece: str):
        nonlocal linked, block_at
        if not piece:
            return
        if not text:
            block_at = next(s for s in reversed(stack) if s[0] not in INLINE)
            if stack[-1][2] and not block_at[2]:
                block_at = stack[-1]
        text.append(piece)
        if in_link:
            linked += len(piece.strip())

    block_at = stack[0]
    lower = page.lower()   # most pages have none of these
    any_foreign, any_select = "<svg" in lower or "<math" in lower, "<select" in lower
    at = 0
    for m in TOKEN.finditer(page):
        say(page[at:m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        foreign = any_foreign and (tag in FOREIGN or any(s[0] in FOREIGN for s in stack))
        inline = tag in INLINE or foreign
        if not inline:
            settle()
        if m["end"]:
            if any(s[0] == tag for s in stack):
                while stack[-1][0] != tag:
                    in_link -= stack.pop()[0] == "a"
                in_link -= stack.pop()[0] == "a"
            tokens.append((f"{stack[-1][1]}</{tag}", None))
            continue
        if tag in VOID or (foreign and m["rest"].rstrip().endswith("/")):
            continue
        if any_select and not inline and tag not in OPTIONS and in_select(stack):
            # A select that was left open ends where other markup begins.
            while in_select(stack):
                in_link -= stack.pop()[0] == "a"
        if not inline:
            # A block ends an open paragraph, an item the item before it.
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == "p" or (stack[i][0] == tag and tag in CLOSED_BY_SAME):
                    while len(stack) > i:
                        in_link -= stack.pop()[0] == "a"
                    break
                if stack[i][0] not in INLINE:
                    break
        _, path, apart, main = stack[-1]
        own, label = _apart(tag, m["rest"], main)
        starts_main = tag in ("article", "main") and not own
        if starts_main and apart and "comment" not in path and not any(s[0] == "article" for s in stack):
            apart = False   # an element before it was left open
        path = f"{path}/{tag}.{label}" if label else f"{path}/{tag}"
        stack.append((tag, path, apart or own, main or starts_main))
        in_link += tag == "a"
        tokens.append((path, None))
    say(page[at:])
    settle()
    return tokens, blocks


def template_texts(pages: list[list[tuple]], support: float = SUPPORT,
                   least_pages: int = LEAST_PAGES) -> set[tuple[str, str]]:
    """(path, text) of the blocks that belong to the template of ``pages``,
    the token lists of pages that differ from each other."""
    n = len(pages)
    if n < least_pages:
        return set()
    vectors: dict[tuple, Counter] = defaultdict(Counter)
    for i, tokens in enumerate(pages):
        for t in tokens:
            vectors[t][i] += 1
    classes = defaultdict(list)
    for token, counts in vectors.items():
        if len(counts) >= support * n:
            classes[tuple(counts.get(i, 0) for i in range(n))].append(token)
    # The class of tokens that stand once on every page is around all others.
    root = set(_ordered(pages, classes.pop((1,) * n, []), (1,) * n))
    out = {t for t in root if t[1] is not None}
    for vector, members in classes.items():
        texts = {t for t in members if t[1] is not None}
        if texts and _ordered(pages, members, vector) and _nested(pages, root, texts):
            out |= texts
    return out


def _ordered(pages: list[list[tuple]], members: list[tuple], vector: tuple) -> list[tuple]:
    """The members if every page repeats them in one order, else none."""
    chosen, order = set(members), None
    for tokens, times in zip(pages, vector):
        if times:
            mine = [t for t in tokens if t in chosen]
            order = order or mine[:len(members)]
            if mine != order * times:
                return []
    return members


def _nested(pages: list[list[tuple]], root: set, texts: set) -> bool:
    """Whether each of the texts follows the same root token on all pages."""
    gaps: dict[tuple, tuple] = {}
    for tokens in pages:
        last = None
        for t in tokens:
            if t in root:
                last = t
            elif t in texts and gaps.setdefault(t, last) != last:
                return False
    return True


def main_text(blocks: list[Block], template: set) -> str:
    """The blocks of the main text, joined by one space: those that are no
    template, or all if they are. Copies of a page are one page in the
    evidence, so their common article is no template. Recurring headings and
    labels of an article stay if a slot follows them: they name its parts."""
    inside = [b for b in blocks if b.main]
    rest = [b for b in inside or blocks if not b.apart]
    if not inside:
        rest = [b for b in rest if 2 * b.linked <= len(b.text)]   # lists of links
    if not template:
        return " ".join(b.text for b in rest)
    kept, named = [], False   # from the end: whether a slot follows, past other labels
    for b in reversed(rest):
        slot = (b.path, b.text) not in template
        label = bool(inside) and b.path.rsplit("/", 1)[-1].split(".", 1)[0] in LABELS
        if slot or (label and named):
            kept.append(b)
        named = slot or (label and named)
    slots = kept[::-1]
    return " ".join(b.text for b in slots or rest)


def _told_apart(blocks: list[Block]) -> tuple[str, ...]:
    """What copies of a page have in common: the texts of its article, or all
    texts that are not set apart where no article holds any."""
    kept = [b for b in blocks if not b.apart]
    return tuple(b.text for b in [b for b in kept if b.main] or kept)


def _hash(*parts) -> int:
    """64 bits of ``parts``, as a signed integer."""
    data = repr(parts).encode("utf-8", "surrogatepass")
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "big", signed=True)


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * len(schema), schema.types)],
                                schema=schema)


COPIES = pa.schema([("host", pa.string()), ("part", pa.int64()), ("copies", pa.int64()), ("page", pa.int64())])
COUNTS = pa.schema([("host", pa.string()), ("token", pa.int64()), ("is_text", pa.bool_()), ("pages", pa.int64()),
                    ("times", pa.int64()), ("vector", pa.int64())])
ORDERS = pa.schema([("host", pa.string()), ("class", pa.int64()), ("token", pa.int64()), ("root", pa.bool_()),
                    ("low", pa.int64()), ("high", pa.int64())])
TEXTS = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])


def _ddl(schema: pa.Schema) -> str:
    return from_arrow_schema(schema).simpleString().removeprefix("struct<").removesuffix(">")


def _copies(group: pa.Table) -> pa.Table:
    """Per different page of a part, the hash of what its copies have in
    common and the hash of the copy that stands for them."""
    host, part = group["host"][0].as_py(), group["part"][0].as_py()
    found: dict[int, int] = {}
    for page in set(group["html"].to_pylist()) - {None}:
        if common := _told_apart(read_page(page)[1]):
            copies, mine = _hash(common), _hash(page)
            found[copies] = min(mine, found.get(copies, mine))
    return _rows([(host, part, *f) for f in found.items()], COPIES)


def _standing(group: pa.Table, known: pa.Table):
    """(hash, ids and texts of the tokens) of each page of a part that stands for its copies."""
    standing = set(known["page"].to_pylist()) - {None}
    if standing:
        for page in set(group["html"].to_pylist()) - {None}:
            mine = _hash(page)
            if mine in standing:
                yield mine, [(_hash(t), t[1] is not None) for t in read_page(page)[0]]


def _counts(support: float):
    """Per token of a part: the pages it is on, its occurrences, and the
    part's share in the hash of its occurrence vector."""
    def run(group: pa.Table, known: pa.Table) -> pa.Table:
        total: dict[tuple, list[int]] = {}
        seen = 0
        for page, tokens in _standing(group, known):
            seen += 1
            for token, n in Counter(tokens).items():
                of = total.setdefault(token, [0, 0, 0])
                of[0] += 1
                of[1] += n
                of[2] ^= _hash(page, n)
        if not seen:
            return COUNTS.empty_table()
        host, whole = known["host"][0].as_py(), known["n"][0].as_py()
        if seen == whole:   # no other part has pages of the host
            total = {t: of for t, of in total.items() if of[0] >= support * whole}
        return _rows([(host, *t, *of) for t, of in total.items()], COUNTS)
    return run


def _orders(group: pa.Table, known: pa.Table) -> pa.Table:
    """Least and greatest hash, over the pages of a part, of the order that a
    class keeps (token 0), and of the root token that stands before each text
    (0 before texts of the root)."""
    class_of, root, texts = {}, set(), set()
    for token, cls, is_root, is_text in zip(*(known[c].to_pylist() for c in ("token", "class", "root", "is_text"))):
        if token is not None:
            class_of[token] = cls
            if is_root:
                root.add(token)
            if is_text:
                texts.add(token)
    found: dict[tuple, list[int]] = {}

    def note(key, *values):
        of = found.setdefault(key, [values[0], values[0]])
        of[:] = min(of[0], *values), max(of[1], *values)

    for _, tokens in _standing(group, known) if class_of else ():
        last, mine = 0, defaultdict(list)
        for token, _ in tokens:
            cls = class_of.get(token)
            if cls is None:
                continue
            mine[cls].append(token)
            if token in root:
                last = token
            if token in texts:
                note((cls, token, token in root), 0 if token in root else last)
        for cls, order in mine.items():
            once = order[:len(set(order))]
            if once * (len(order) // len(once)) == order:
                note((cls, 0, once[0] in root), _hash(once))
            else:
                note((cls, 0, once[0] in root), 0, 1)   # no order
    return _rows([(known["host"][0].as_py(), *k, *of) for k, of in found.items()], ORDERS)


def _extract(group: pa.Table, known: pa.Table) -> pa.Table:
    template = set(known["token"].to_pylist())
    out = []
    for i, u, page in zip(*(group[c].to_pylist() for c in ("page_id", "url", "html"))):
        blocks = read_page(page or "")[1]
        mine = {t for t in {(b.path, b.text) for b in blocks} if _hash(t) in template} if template else template
        text = main_text(blocks, mine)
        out.append((i, u, text, len(text)))
    return _rows(out, TEXTS)


def extract_main_text(pages: DataFrame, chunk: int = CHUNK, support: float = SUPPORT,
                      least_pages: int = LEAST_PAGES) -> DataFrame:
    """(page_id, url, text, n_chars) of every page.

    A host has one template, that of ``template_texts`` on all its different
    pages: of copies (pages with the same article texts, or without an article
    the same texts that are not set apart) the one with the smallest hash is
    evidence, pages without text are none. A host with fewer than
    ``least_pages`` different pages has no template: its pages keep all that
    no tag, role or name sets apart. The result does not depend on the order
    or the partitions of the table.

    Pages of a host are read together, up to ``chunk`` of them and about
    ``CHUNK_BYTES``; larger hosts are dealt out by page_id and url, so that no
    task holds a whole large host. Their
    parts only count: occurrence vectors are hashed and added up per host and
    token, orders are compared per host and class, and the valid texts go back
    to the parts. The pages are shuffled once.

    Null and empty pages have an empty text. Pages without url are a host of
    their own, null page_ids are carried, repeated rows give a row each,
    broken markup is read as far as it goes. Other columns are not read; an
    empty table gives no rows.
    """
    spark = pages.sparkSession
    host = F.lower(F.coalesce(F.regexp_extract("url", r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1), F.lit("")))
    pages = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"),
                         host.alias("host"))
    counts = pages.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("html")).alias("bytes"))
    split = F.greatest(F.ceil(F.col("n") / chunk), F.ceil(F.coalesce("bytes", F.lit(0)) / CHUNK_BYTES))
    parts = materialize(counts.select("host", split.cast("long").alias("parts")).filter("parts > 1"))
    small = F.broadcast if parts.count() <= FEW_HOSTS else (lambda df: df)
    dealt = (pages.join(small(parts), "host", "left")
             .withColumn("part", F.pmod(F.xxhash64("page_id", "url"), F.coalesce("parts", F.lit(1)))).drop("parts"))
    by_part = dealt.groupBy("host", "part")

    def ask(known: DataFrame, answer, schema: pa.Schema) -> DataFrame:
        return by_part.cogroup(known.groupBy("host", "part")).applyInArrow(answer, _ddl(schema))

    def to_parts(known: DataFrame) -> DataFrame:
        number = F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("parts", F.lit(1)) - 1))
        return known.join(small(parts), "host", "left").withColumn("part", number).drop("parts")

    standing = (by_part.applyInArrow(_copies, _ddl(COPIES)).groupBy("host", "copies")
                .agg(F.min(F.struct("page", "part")).alias("first")).select("host", "first.part", "first.page"))
    sizes = standing.groupBy("host").agg(F.count("page").alias("n")).filter(F.col("n") >= least_pages)
    standing = standing.join(sizes, "host")
    tokens = (ask(standing, _counts(support), COUNTS).groupBy("host", "token")
              .agg(F.first("is_text").alias("is_text"), F.sum("pages").alias("pages"), F.sum("times").alias("times"),
                   F.bit_xor("vector").alias("class"))
              .join(sizes, "host").filter(F.col("pages") >= support * F.col("n"))
              # The class of tokens that stand once on every page is around all others.
              .select("host", "token", "is_text", "class",
                      ((F.col("pages") == F.col("n")) & (F.col("times") == F.col("n"))).alias("root")))
    known = to_parts(tokens).unionByName(standing.drop("n"), allowMissingColumns=True)
    orders = (ask(known, _orders, ORDERS).groupBy("host", "class", "token", "root")
              .agg((F.min("low") == F.max("high")).alias("same")))
    whole, of_class = F.col("token") == 0, Window.partitionBy("host", "class")
    template = (orders.withColumn("ordered", F.bool_and(F.col("same") | ~whole).over(of_class))
                .withColumn("nested", F.bool_and(F.col("same") | whole).over(of_class))
                .withColumn("rooted", F.bool_or(F.col("same") & whole & F.col("root")).over(Window.partitionBy("host")))
                .filter(~whole & F.col("ordered") & (F.col("nested") | ~F.col("rooted"))).select("host", "token"))
    return ask(to_parts(template), _extract, TEXTS)


@query("op8_equivalence_class_templates")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))
