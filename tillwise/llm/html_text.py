"""Main text of web pages by two passes of block rules.

The first pass calls a block bad by its element (menus, footers, forms and the like) or its link density, good by
length and stop-word density, and leaves short blocks open. The second pass gives open blocks the label of the nearest
decided neighbours. A page's article or main element, where there is one, bounds the search for neighbours.

Class names and ids only weigh: a container with a bad name is bad as long as the page has main text elsewhere, that is
in an article or main container or more of it; else its blocks are judged like any others. Frequent words are counted
over the whole table per stated language; where they do not tell prose apart, length and link density decide.

Hidden elements (scripts, icons, form fields, elements that hide themselves) give no text, no block and no border: a
paragraph goes on behind them. Formulas belong to their sentence. A comment, tag or declaration that never ends takes the
rest of the page with it, as in browsers, so a page is read in linear time.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.llm.common import small_batches
from tillwise.session import materialize

#: Languages of the fixed list of frequent words.
FIXED = {"en", "de", "fr", "es"}
#: Links' share of a bad block's characters; stop words' share of a good block's words; characters of a decided block.
LINKS, STOPS, LONG = 0.5, 0.15, 70
#: A language's frequent words have this share of its words each; words of a language from which they are told; longest one.
FREQUENT, EVIDENCE, WORD = 0.005, 1000, 30
#: Marks that are no part of a word at its ends, and distinct tokens that a task counts before it hands them on.
MARKS, HELD = ".,;:!?", 200_000
#: Characters of good blocks from which a container is judged without its name.
NAMED = 3 * LONG

# Elements of HTML by their role, and frequent words of four languages.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var".split())
FORMULA = set("math semantics mi mn mo ms mtext mrow mfrac msqrt mroot msub msup msubsup munder mover munderover mtable mtr mtd mstyle".split())
WITHIN = INLINE | FORMULA
HIDDEN = set(
    "head title script style noscript template svg iframe object canvas audio video select textarea button datalist annotation "
    "annotation-xml".split()
)
IN_HEAD = set("head title script style noscript template meta link base".split())
OUTSIDE = set("nav footer aside form dialog menu fieldset".split())
MAIN = {"article", "main"}
SELF_CLOSING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BAD_ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form".split())
BAD_NAMES = set(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "sidebar side footer cookie cookies consent gdpr notice notices alert popup modal overlay comment comments disqus respond "
    "discussion discussions responses reactions feedback replies share sharing social related recommended newsletter subscribe signup login search breadcrumb breadcrumbs widget form".split()
)
BAD_OUTSIDE_MAIN = {"header", "masthead", "topbar", "toolbar"}
UNNAMED = {"html", "body", "main", "article"}
NEGATED = {"has", "no", "not", "with", "without", "hide", "show"}
GOOD_NAMES = {"article", "content", "main", "post", "entry", "story"}
STOP_WORDS = set(
    "the of and to in a is that it was for on are as with his they be at this have from or by not but what all were when we there an "
    "der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach wird bei "
    "de la le et les des en un du une que est pour qui dans par plus pas au sur se ne ce il sont avec aux "
    "el que los y las del por con no una su para al lo como más pero sus este".split()
)


Block = tuple[str, int, bool, int, int]
#: The parts of blocks as columns.
PARTS = {"texts": pa.string(), "linked": pa.int32(), "bad": pa.bool_(), "mains": pa.int32(), "named": pa.int32()}


def _names(values: dict[str, str]) -> tuple[set[str], set[str]]:
    """Whole class names and ids, and those with their first and last parts; names such as has-sidebar say nothing."""
    whole = set(" ".join((values.get("class", ""), values.get("id", ""))).lower().replace("_", "-").split())
    parts = [n.split("-") for n in whole]
    parts = [p for p in parts if p[0] not in NEGATED and p[-1] != "free"]
    return whole, whole | {p[0] for p in parts} | {p[-1] for p in parts}


class _Blocks(HTMLParser):
    """Blocks of a page in order: (text, characters in links, in a bad container, main container number or 0, number of the
    container with a bad name or 0). Blocks that are bad whatever they say have no text.

    A page is fed whole, so what has no end in it has none."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.open: list[tuple[str, bool, int, int, bool]] = []
        self.count: Counter = Counter()
        self.mains = self.named = 0
        self.language = ""
        self.parts: list[str] = []
        self.linked = self.links = self.in_link = 0
        self.sections = True

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        """Sections that are no HTML end at the next angle bracket, those of character data behind their brackets."""
        if self.sections and self.rawdata.startswith("<![CDATA[", i):
            end = self.rawdata.find("]]>", i)
            if end >= 0:
                return end + 3
            self.sections = False
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else -1

    def _or_all(self, end: int) -> int:
        return end if end >= 0 else len(self.rawdata)

    def parse_starttag(self, i: int) -> int:
        return self._or_all(super().parse_starttag(i))

    def parse_endtag(self, i: int) -> int:
        return self._or_all(super().parse_endtag(i))

    def parse_comment(self, i: int, report: int = 1) -> int:
        """Comments end at --> or --!>; <!--> and <!---> are whole ones."""
        found = re.compile("--!?>|(?<=<!--)-?>").search(self.rawdata, i + 4)
        return found.end() if found else len(self.rawdata)

    def parse_pi(self, i: int) -> int:
        return self._or_all(super().parse_pi(i))

    def parse_html_declaration(self, i: int) -> int:
        return self._or_all(super().parse_html_declaration(i))

    def _state(self) -> tuple[bool, int, int]:
        return self.open[-1][1:4] if self.open else (False, 0, 0)

    def _hidden(self) -> bool:
        return bool(self.open) and self.open[-1][4]

    def _end_block(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text:
            bad, main, named = self._state()
            # prose of an article that is wholly a link is no list of links
            linked = 0 if main and self.linked >= LONG * self.links else self.linked
            if bad or linked > LINKS * len(text):
                text, linked, bad = "", 0, True
            self.blocks.append((text, linked, bad, main, named))
        self.parts.clear()
        self.linked = self.links = self.in_link = 0

    def _drop(self, tags: set[str], through: set[str] | None = None) -> None:
        """Close the innermost open element of tags, if no block element outside through lies above it."""
        if not any(self.count[t] for t in tags):
            return
        for i in range(len(self.open) - 1, -1, -1):
            tag = self.open[i][0]
            if tag in tags:
                for t, *_ in self.open[i:]:
                    self.count[t] -= 1
                del self.open[i:]
                return
            if through is not None and tag not in through:
                return

    def _imply_ends(self, tag: str) -> None:
        """A block ends an open paragraph, and an item or cell the one before."""
        self._drop({"p"}, INLINE | {"p"})
        if tag in SELF_CLOSING:
            self._drop(SELF_CLOSING[tag], INLINE | {"p"})

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in IN_HEAD and self.open and self.open[-1][0] == "head":
            self._drop({"head"})
        block = tag not in WITHIN and tag not in HIDDEN
        if self._hidden() and block and tag not in VOID:
            self._imply_ends(tag)
        if self._hidden():
            if tag not in VOID:
                self.open.append((tag, *self._state(), True))
                self.count[tag] += 1
            return
        if tag in VOID:
            self.parts.append(" ")
            if tag == "hr":
                self._end_block()
            return
        values = {k: v or "" for k, v in attrs}
        bad, main, named = self._state()
        if tag == "html":
            found = re.match("[a-z]{2,3}(?![a-z])", values.get("lang", "").strip().lower())
            self.language = found.group() if found else self.language
        whole, names = _names(values)
        hidden = tag in HIDDEN or "hidden" in values or "display:none" in values.get("style", "").replace(" ", "").lower()
        worse = not hidden and (
            tag in OUTSIDE or values.get("role", "").lower() in BAD_ROLES or (not main and tag == "header")
        )
        doubted = not hidden and tag not in UNNAMED and not whole & GOOD_NAMES and (names & BAD_NAMES or (not main and names & BAD_OUTSIDE_MAIN))
        if block or worse or doubted:
            self._end_block()
            if block:
                self._imply_ends(tag)
                bad, main, named = self._state()
        elif tag == "a":
            self.in_link += 1
            self.links += 1
        if not bad and not worse and not main and (tag in MAIN or (block and names & GOOD_NAMES)):
            self.mains += 1
            main = self.mains
        if doubted and not named:
            self.named += 1
            named = self.named
        self.open.append((tag, bad or bool(worse), main, named, hidden))
        self.count[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        closes = tag in HIDDEN or tag in FORMULA or self._hidden()
        self.handle_starttag(tag, attrs)
        if closes:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if self._hidden():
            self._end_hidden(tag)
            return
        if tag == "a":
            self.in_link = max(0, self.in_link - 1)
        if (tag not in WITHIN and tag not in HIDDEN) or self._state()[0] or self._starts_named(tag):
            self._end_block()
        self._drop({tag}, WITHIN if tag in WITHIN else None)

    def _end_hidden(self, tag: str) -> None:
        """An end tag within a hidden element closes one of its elements, itself, or a block around it."""
        if not self.count[tag]:
            return
        i = len(self.open) - 1
        while i >= 0 and self.open[i][4] and self.open[i][0] != tag:
            i -= 1
        if i >= 0 and self.open[i][4]:
            self._drop({tag})
        elif tag not in WITHIN:
            self._end_block()
            self._drop({tag})

    def _starts_named(self, tag: str) -> bool:
        """Whether the innermost element is of this tag and the one with the bad name."""
        before = self.open[-2][3] if len(self.open) > 1 else 0
        return bool(self.open) and self.open[-1][0] == tag and self.open[-1][3] != before

    def handle_data(self, data: str) -> None:
        if self._hidden():
            return
        self.parts.append(data)
        if self.in_link:
            self.linked += len(data)

    def close(self) -> None:
        super().close()
        self._end_block()


def blocks_of(html: str) -> tuple[str, list[Block]]:
    """The page's stated language ("" if none) and its blocks."""
    parser = _Blocks()
    parser.feed(html)
    parser.close()
    return parser.language, parser.blocks


def _words(text: str) -> list[str]:
    return [w.strip(MARKS) for w in text.lower().split()]


def first_pass(text: str, linked: int, bad: bool, main: int, stops: frozenset[str] | None) -> bool | None:
    """True for a good block, False for a bad one, None for an open one. Without stop words length and links decide."""
    if bad or linked > LINKS * len(text):
        return False
    if len(text) < LONG:
        return None
    if main or stops is None:
        return True
    words = _words(text)
    return sum(map(stops.__contains__, words)) >= STOPS * len(words)


def second_pass(first: list[bool | None], mains: list[int]) -> list[bool]:
    """Open blocks take the nearest decided label: within their own main container if it has any, which else is good."""
    out = []
    before: dict[int, list[tuple[int, bool] | None]] = {}
    for order in (range(len(first)), range(len(first) - 1, -1, -1)):
        last: dict[int, tuple[int, bool]] = {}
        for i in order:
            key = mains[i]
            before.setdefault(i, []).append(last.get(key))
            if first[i] is not None and (not key or first[i]):
                last[key] = (i, bool(first[i]))
    for i, label in enumerate(first):
        if label is None:
            near = sorted((abs(i - j), good) for j, good in filter(None, before[i]))
            label = bool(mains[i]) if not near else near[0][1]
        out.append(label)
    return out


def _doubted(blocks: list[Block], first: list[bool | None]) -> set[int]:
    """Numbers of the containers that stay bad by their names: all, if the page has main text elsewhere."""
    named = {b[4] for b in blocks if b[4]}
    good = Counter()
    for b, label in zip(blocks, first, strict=True):
        if label:
            good[b[4]] += len(b[0])
            if b[3] and not b[4]:
                return named
    return {k for k in named if good[k] < NAMED or good[k] <= good[0]}


def main_text(html: str | None) -> str:
    """The page's main text: good blocks, one a line. Null and empty pages have none.

    One page does not tell the frequent words of a language beyond the fixed lists: length and link density decide there.
    """
    language, blocks = blocks_of(html or "")
    return text_of(blocks, language, {} if language in FIXED else {language: None} if language else {})


def text_of(blocks: list[Block], language: str, frequent: dict[str, frozenset[str] | None]) -> str:
    """Good blocks, one a line; frequent has the stop words of languages, or None where they tell nothing."""
    stops = frequent.get(language, frozenset(STOP_WORDS))
    first = [first_pass(*b[:4], stops) for b in blocks]
    if not language and not any(first):
        # no language is stated and no frequent word of a known one marks a block
        first = [first_pass(*b[:4], None) for b in blocks]
    if any(b[4] for b in blocks):
        doubted = _doubted(blocks, first)
        first = [False if b[4] in doubted else label for b, label in zip(blocks, first, strict=True)]
    labels = second_pass(first, [b[3] for b in blocks])
    inside = any(good and b[3] for b, good in zip(blocks, labels, strict=True))
    return "\n".join(b[0] for b, good in zip(blocks, labels, strict=True) if good and (b[3] or not inside))


def frequent_words(blocks: DataFrame) -> dict[str, frozenset[str] | None]:
    """Stop words of the languages stated in blocks (lang, texts, linked, bad), counted over all long blocks.

    None for a language of which there are too few words, or whose frequent words are no great part of its words. The
    four languages of the fixed list keep that, and pages without a language have the words of all.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = {}
        for batch in batches:
            for lang, texts, linked, bad in zip(*(batch.column(c).to_pylist() for c in ("lang", "texts", "linked", "bad")), strict=True):
                own = seen.setdefault(lang, Counter())
                for t, n, b in zip(texts, linked, bad, strict=True):
                    if not b and len(t) >= LONG and n <= LINKS * len(t):
                        own.update(t.lower().split())
            if sum(map(len, seen.values())) > HELD:
                yield handed(seen)
                seen = {}
        yield handed(seen)

    def handed(seen: dict[str, Counter]) -> pa.RecordBatch:
        rows = [(lang, w.strip(MARKS), n) for lang, own in seen.items() for w, n in own.items()]
        columns = zip(*((lang, w if len(w) <= WORD else "", n) for lang, w, n in rows), strict=True) if rows else [[]] * 3
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    names, kinds = ["lang", "word", "n"], [pa.string(), pa.string(), pa.int64()]
    # a block's words lie one space apart; so the sums need no table of all words
    block = blocks.select("lang", F.explode(F.arrays_zip("texts", "linked", "bad")).alias("b")).select("lang", "b.*")
    size = F.length("texts")
    long = block.where(~F.col("bad") & (size >= LONG) & (F.col("linked") <= LINKS * size))
    # bounded: a row for each name of two or three letters
    totals = {r["lang"]: r["n"] for r in long.groupBy("lang").agg(F.sum(F.size(F.split("texts", " "))).alias("n")).collect()}
    evident = [(lang, n) for lang, n in totals.items() if n >= EVIDENCE]
    counts = blocks.select("lang", "texts", "linked", "bad").mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    whole = F.broadcast(blocks.sparkSession.createDataFrame(evident, "lang string, total long"))
    # bounded: 1 / FREQUENT words a language of which there is evidence
    often = counts.join(whole, "lang").where((F.col("n") >= FREQUENT * F.col("total")) & (F.col("word") != "")).select("lang", "word", "n").collect()
    out: dict[str, frozenset[str] | None] = {}
    every = set(STOP_WORDS)
    by_lang: dict[str, dict[str, int]] = {lang: {} for lang in totals}
    for r in often:
        by_lang[r["lang"]][r["word"]] = r["n"]
    for lang in sorted(totals, reverse=True):
        own = by_lang[lang]
        told = totals[lang] >= EVIDENCE and sum(own.values()) >= 2 * STOPS * totals[lang]
        every |= set(own) if told else set()
        known = told or lang in FIXED
        out[lang] = (frozenset(STOP_WORDS | set(own)) if told else frozenset(STOP_WORDS)) if known else None
    if "" in out:
        out[""] = frozenset(every)
    return out


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of pages (page_id, url, html, any more columns).

    Null and empty html give an empty text; null ids and URLs stay null; repeated rows are read each.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in small_batches(batches, "html"):
            pages = [blocks_of(x or "") for x in b.column("html").to_pylist()]
            parts = [pa.array([[x[i] for x in blocks] for _, blocks in pages], pa.list_(k)) for i, k in enumerate(PARTS.values())]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array([lang for lang, _ in pages], pa.string()), *parts],
                ["page_id", "url", "lang", *PARTS],
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    blocks = materialize(
        pages.select("page_id", "url", "html").mapInArrow(
            parse, f"page_id {kind}, url string, lang string, texts array<string>, linked array<int>, bad array<boolean>, mains array<int>, named array<int>"
        ),
        "html-blocks",
    )
    frequent = frequent_words(blocks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = zip(b.column("lang").to_pylist(), *(b.column(c).to_pylist() for c in PARTS), strict=True)
            texts = [text_of(list(zip(*parts, strict=True)), lang, frequent) for lang, *parts in rows]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return blocks.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
