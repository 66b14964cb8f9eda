"""Sentence boundaries across languages and scripts, by semi-Markov dynamic programming.

A text is cut at blank lines into units. Within a unit every mark that may end a sentence is
a candidate boundary; a segmentation is a path over candidates, and each step of the path is
a whole sentence span. A span's score is the sum of what its opening word says, what its
closing word and mark say, its length in words (very short spans are rare, the more so where
the closing word may be an abbreviation) and a penalty for each quotation or bracket that it
cuts. The best path is found by dynamic programming over spans of any length.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame

# Marks that end sentences in their scripts, and marks that open or close passages.
FULL_MARKS = "。！？｡．‼⁇⁈⁉।॥؟۔։።፧፨။។៕᠃᠉꓿"
PLAIN_MARKS = ".!?…‥"
PAIRS = {"(": ")", "[": "]", "{": "}", "«": "»", "“": "”", "„": "“", "‚": "‘", "「": "」", "『": "』", "（": "）", "【": "】", "《": "》", "〈": "〉", "〔": "〕", "［": "］", "‹": "›", "｢": "｣"}
CLOSERS = "".join(dict.fromkeys([*PAIRS.values(), '"', "”", "’", "'"]))
QUOTE_CLOSERS = set('"”“’\'»›」』｣‘')
OPENERS = "".join([*PAIRS, '"', "'", "‘", "¿", "¡", "»"])

# Abbreviations by what their point says, in lower case without the last point.
#: followed by a name: never the end
TITLES = set("dr mr mrs ms prof st sr sra srta dra m mm mme mlle mgr hr fr gen col sgt capt lt maj gov sen rep rev hon ing dipl د أ م डॉ प्रो श्री κ κα δρ г-н г-жа д-р проф акад им ул".split())
#: tie what follows to what precedes: never the end
CONNECTIVES = set("e.g i.e eg ie a.k.a aka vs viz cf vgl z.b d.h bzw ca circa approx aprox env sog ggf evtl inkl zzgl bzgl p.ex par ex p.ej ej т.е т.к см напр ср δηλ βλ π.χ πρβλ resp incl excl s.o s.u u.u i.d.r v.a".split())
#: stand before a number: the end only before a new sentence's capital
COUNTED = set("no nos nr n abb fig figs sec sect app ch chap vol p pp pág págs pag art par para eq tab kap bd ver v núm rev рис стр гл п ст табл σελ εικ κεφ ref q lit ausg aufl anm".split())
#: may end a sentence: they do before a capital
ENDING = set("etc usw usf u.s u.k u.n e.u u.s.a d.c p.m a.m inc ltd corp co llc jr bros plc ph.d b.c a.d и.т.д т.д т.п др κ.λπ κλπ κ.ά κτλ ff jan feb mar apr jun jul aug sep sept oct nov dec mon tue tues wed thu thur thurs fri sat sun min hr hrs est dept ave blvd rd ч г гг в вв тыс руб ua u.a u.ä o.ä".split())
#: of these, the ones that also stand before a number
DATES = set("jan feb mar apr jun jul aug sep sept oct nov dec mon tue tues wed thu thur thurs fri sat sun min hr hrs est dept ave ч г".split())
#: capitalised words that go on after a country or company name
CONTINUING = set("east west north south central eastern western northern southern government army navy senate congress department treasury president".split())
#: words that open sentences
OPENING = set(
    "the a an they it we he she i you this that these those there then and but if for from by as at in on to all any some no not our your their his her its my what why who how when where which is are was were do does did has have had can could will would should may might must please ask check note see stop after before between while since until because so or nor yet however also only both each every another most many few one two".split()
)
#: month names after a day's ordinal
MONTHS = set("januar jänner februar märz april mai juni juli august september oktober november dezember".split())
#: words before an ordinal
BEFORE_ORDINAL = set("am der die das dem den des im zum zur vom beim bis ab seit und oder jeder jede jedes ein eine einem einen einer".split())
#: programs written in lower case even where they open a sentence
PROGRAMS = set("iptables nftables sshd ssh systemd nginx httpd kernel cron sudo grep tcpdump nmap curl wget bash auditd rsyslogd journald dnsmasq openssl kubectl git".split())

# characters given by number: line and paragraph separators, no-break spaces, the Greek question mark
_SEPARATORS = chr(0x2028) + chr(0x2029)
_SPACES = " " + chr(0xA0) + chr(0x202F)
GREEK_QUESTION = chr(0x37E)
_BREAK = rf"(?:\r\n|[\n\r\x0b\x0c\x85{_SEPARATORS}])"
_BLANK = re.compile(rf"{_BREAK}(?:[^\S\n\r\x0b\x0c\x85{_SEPARATORS}]*{_BREAK})+|" + chr(0x2029))
_THAI = f"{chr(0xE01)}-{chr(0xE3A)}{chr(0xE40)}-{chr(0xE4E)}"
_CAND = re.compile(
    rf"(?P<full>[{FULL_MARKS}]+[{FULL_MARKS}.!?…]*|[….]{{2,}}[!?]*|[…‥]+|[.!?]+…?(?![0-9A-Za-z_/=&%+-])|(?P<greek>[;{GREEK_QUESTION}](?=[{re.escape(CLOSERS)}]*(?:\s|$))))(?P<close>[{re.escape(CLOSERS)}]*)"
    rf"(?:[{_SPACES}]+(?P<late>[»›]))?"
    rf"|(?<=[{_THAI}])(?P<thai>[\t{_SPACES}{chr(0x3000)}]+)(?=[{_THAI}])"
)
_SPACE = re.compile(r"\s*")
_TOKEN = re.compile(r"\S+")


_OPENERS_OF: dict[str, tuple[str, ...]] = {}
for _o, _c in [*PAIRS.items(), ("»", "«")]:
    _OPENERS_OF[_c] = (*_OPENERS_OF.get(_c, ()), _o)
_MARK = re.compile("[" + re.escape("".join(dict.fromkeys([*PAIRS, *PAIRS.values(), '"']))) + "]")


def _pairs(text: str) -> list[tuple[int, int]]:
    """Matched quotations and brackets, by a stack; straight quotes get a direction from blanks."""
    out: list[tuple[int, int]] = []
    stack: list[tuple[str, int]] = []
    open_ = Counter()  # openers in the stack by character; a closer without one is passed at once
    n = len(text)

    def drop(k: int) -> None:
        for c, _ in stack[k:]:
            open_[c] -= 1
        del stack[k:]

    def push(c: str, i: int) -> None:
        stack.append((c, i))
        open_[c] += 1

    for m in _MARK.finditer(text):
        i, c = m.start(), m[0]
        follows = i + 1 < n and not text[i + 1].isspace()
        if c == '"':
            after_blank = i == 0 or text[i - 1].isspace()
            if open_[c]:
                k = next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == c)
                if not (after_blank and follows):
                    out.append((stack[k][1], i))
                drop(k)
                if not (after_blank and follows):
                    continue
            push(c, i)  # where one is open and another opens, the old one was no quotation
            continue
        openers = [o for o in _OPENERS_OF.get(c, ()) if open_[o]]
        if c == "“" and openers and not open_["„"]:
            openers = []  # it opens another passage, or closes nothing that it opened
        if openers:
            k = next(k for k in range(len(stack) - 1, -1, -1) if stack[k][0] in openers)
            out.append((stack[k][1], i))
            drop(k)
        elif c in PAIRS or (c == "»" and follows and (i == 0 or text[i - 1].isspace())):
            push(c, i)
    return out


def _is_cjk(c: str) -> bool:
    n = ord(c)
    return 0x3040 <= n <= 0x30FF or 0x3400 <= n <= 0x9FFF or 0xAC00 <= n <= 0xD7A3 or 0xF900 <= n <= 0xFAFF or 0x20000 <= n <= 0x3FFFF


def _case(token: str) -> str:
    """Of a token's first letter or digit: upper, lower, tech, digit, other (no case) or mark."""
    t = token.lstrip(OPENERS)
    if not t:
        return "mark"
    c = t[0]
    if c.isdigit():
        return "digit"
    if not c.isalpha():
        return "mark"
    if c.isupper() or c.istitle():
        return "upper"
    if c.islower():
        core = t.rstrip(".,;:!?…" + CLOSERS)
        if core.lower() in PROGRAMS or any(x.isdigit() for x in core) or re.search(r"[._/\\]\w", core) and core.lower() not in CONNECTIVES | ENDING:
            return "tech"
        return "lower"
    return "other"


#: what a span's opening word says, by its case
OPENING_SCORES = {"upper": 1.0, "other": 1.0, "mark": 0.5, "tech": 0.0, "digit": 0.0, "lower": -1.0}
#: what a span's length says, in words (a letter of a script without blanks is one): by set weights
LENGTH_SCORES = {1: -0.75, 2: -0.25}
#: and where the closing word may be an abbreviation ('The U.S.') or a list number ('1.')
SHORT_SCORE = -6.0
CUT_SCORE = -10.0  # a quotation or bracket that goes on beyond the span
SURE = 3.0  # a boundary of this score stands whatever the lengths of the spans beside it


class _Candidate:
    """A possible boundary: ``score`` is what the word and mark before it (``close``) and the word
    after it (``open``) say together. ``short`` and ``lead``: no end if the span has two words, or one."""

    __slots__ = ("end", "start", "score", "short", "lead", "open")

    def __init__(self, end: int, start: int, score: float, short: bool = False, lead: bool = False):
        self.end, self.start, self.score, self.short, self.lead = end, start, score, short, lead
        self.open = 0.0

    @property
    def close(self) -> float:
        return self.score - self.open


def _last_word(text: str, stop: int) -> tuple[str, int]:
    """The word that ends at or, over blanks, before ``stop``, and its start."""
    while stop and text[stop - 1].isspace():
        stop -= 1
    start = stop
    while start and not text[start - 1].isspace():
        start -= 1
    return text[start:stop], start


def _abbreviation(text: str, stop: int) -> tuple[str, str, int]:
    """The word before the point at ``stop``, joined with spaced letters before it ('z. B' → 'z.b'),
    the word before that, and where the abbreviation starts."""
    if stop and text[stop - 1].isspace():
        return "", "", stop
    raw, start = _last_word(text, stop)
    word = raw.lstrip(OPENERS)
    while True:
        before, at = _last_word(text, start)
        before = before.lstrip(OPENERS)
        joined = f"{before}{word}".lower().rstrip(".")
        if len(before) == 2 and before[1] == "." and (joined in CONNECTIVES or joined in ENDING or joined == "т.д"):
            word, start = before + word, at
        else:
            return word, before, start


def _blank_between(text: str, start: int, stop: int) -> bool:
    while stop > start and text[stop - 1].isspace():
        stop -= 1
    return stop <= start


class _Letters:
    """Letters and Greek letters up to each place of a unit, counted once where they are asked for."""

    def __init__(self, text: str):
        self.text, self.counts = text, None

    def between(self, start: int, stop: int) -> tuple[int, int]:
        if self.counts is None:
            greek = lambda c: 0x370 <= ord(c) <= 0x3FF or 0x1F00 <= ord(c) <= 0x1FFF
            self.counts = [[0, *accumulate(c.isalpha() for c in self.text)], [0, *accumulate(c.isalpha() and greek(c) for c in self.text)]]
        return self.counts[0][stop] - self.counts[0][start], self.counts[1][stop] - self.counts[1][start]


def _score(text: str, m: re.Match, since: int, letters_of: _Letters) -> _Candidate | None:
    """A candidate boundary with its score, or None where the mark can't end a sentence."""
    if m["thai"]:
        return _Candidate(m.start(), m.end(), 4.0)
    marks, close, end = m["full"], m["close"] or "", m.end()
    if m["late"]:
        close += m["late"]
    after = _SPACE.match(text, end).end()
    gap = after > end
    token = _TOKEN.match(text, after)
    nxt = token[0] if token else ""
    full = marks[0] in FULL_MARKS and not (marks[0] == "．" and text[m.start() - 1 : m.start()].isdigit() and nxt[:1].isdigit())
    if not nxt:
        return _Candidate(end, after, 9.0)
    wide = _is_cjk(nxt[0]) or nxt[0] in FULL_MARKS + "「『（【《“〈"
    ellipsis = marks[0] in "…‥" or marks.startswith("..")
    if not gap and not (full or (wide and not m["greek"] and (ellipsis or marks[0] in "!?"))):
        return None
    case = _case(nxt)
    quoted = any(c in QUOTE_CLOSERS for c in close)
    if m["greek"]:
        letters, greek = letters_of.between(min(since, m.start()), m.start())
        if m["greek"] != GREEK_QUESTION and greek < 0.25 * letters or not letters:
            return None
        if not close:
            return _Candidate(end, after, 3.0)
    if close:  # the mark stands inside; the sentence around may go on
        if nxt[0] in ",;:،、，：；" or nxt[0] in "—–-" or case == "lower":
            return _Candidate(end, after, -8.0)
        if not gap and wide:
            whole = close[-1] in "）)]】" and text[since : since + 1] in "（(【["
            return _Candidate(end, after, 3.0 if whole or nxt[0] in "「『“（" and quoted else -8.0)
        return _Candidate(end, after, 2.0)
    if ellipsis:
        return _Candidate(end, after, -8.0 if case == "lower" or nxt[0] in ",;:)" else 3.0)
    if full or "!" in marks or "?" in marks:
        return _Candidate(end, after, 3.0)

    # a single point
    word, before, start = _abbreviation(text, m.start())
    key = word.lower().rstrip(".")
    capital = case in ("upper", "mark", "tech", "other")
    lead = _blank_between(text, since, start)  # the word opens the span
    first = nxt.lstrip(OPENERS).rstrip(".,;:!?" + CLOSERS).lower()
    if not key:
        return _Candidate(end, after, 1.0)
    if key.isdigit() and len(key) <= 4:
        if first in MONTHS or before.lower() in BEFORE_ORDINAL:
            return _Candidate(end, after, -6.0)
        if case == "lower":  # an ordinal after a short word, else a number that ends its sentence
            return _Candidate(end, after, -6.0 if len(before) <= 3 else 1.0, lead=True)
        return _Candidate(end, after, 3.0, lead=True)
    if any(c.isdigit() for c in key):
        return _Candidate(end, after, 3.0 if case != "lower" else 1.0)
    if 0xE00 <= ord(key[-1]) <= 0xE7F:
        return _Candidate(end, after, -4.0)
    if len(key) <= 3 and word.isalpha() and word.islower() and before[-1:].isdigit() and case != "lower" and key not in ENDING:  # a unit after a number
        return _Candidate(end, after, 3.0)
    if key in TITLES:
        return _Candidate(end, after, -6.0)
    if key in CONNECTIVES:
        return _Candidate(end, after, -6.0)
    if key in COUNTED:
        return _Candidate(end, after, -6.0 if case in ("digit", "lower") or first[:1].isdigit() else (2.0 if case == "upper" and key == "no" or len(key) > 2 and first in OPENING else -3.0))
    if key in ENDING:
        if case == "lower" or case == "digit" and key in DATES or first in CONTINUING:
            return _Candidate(end, after, -6.0)
        return _Candidate(end, after, 2.0, short=True)
    if len(key) == 1:
        if key.isalpha() and word.isupper() and case == "upper" and first in OPENING and before[:1].islower():
            return _Candidate(end, after, 2.0, short=True)
        return _Candidate(end, after, -5.0 if not _is_cjk(key) else 3.0)
    if re.fullmatch(r"(?:[^\W\d_]\.)+[^\W\d_]", key):  # letters with points, an unknown abbreviation
        return _Candidate(end, after, 1.0 if capital and first in OPENING else -3.0)
    if case == "lower":
        return _Candidate(end, after, -1.0 if len(key) <= 3 and not lead else 1.0)
    return _Candidate(end, after, 3.0)


_LENGTH_UNIT = re.compile("[\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff\u0e01-\u0e7f]|[^\\s\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff\u0e01-\u0e7f]+")


def _candidates(text: str) -> list[_Candidate]:
    out: list[_Candidate] = []
    since, letters = 0, _Letters(text)
    for m in _CAND.finditer(text):
        c = _score(text, m, since, letters)
        if c is None:
            continue
        if c.end >= len(text):
            break
        word = _TOKEN.match(text, c.start)
        c.open = OPENING_SCORES[_case(word[0])] if word and not m["thai"] else 0.0
        out.append(c)
        if c.score > 0:
            since = c.start
    return out


def _unit(text: str) -> list[tuple[int, int]]:
    """Best segmentation of a unit without outer white space; offsets within it.

    Node j is the boundary after candidate j - 1, node 0 the unit's start, node n + 1 its end. The
    score of a span from node i to node j is ``open(i) + close(j) + length(i, j) + cut(j)``. Length
    counts for spans of one or two words only, so for each j the nodes before are weighed in three
    groups, of which the two near ones are looked through and of the far one only the best counts:
    exact, and linear in the number of nodes.
    """
    cands = _candidates(text)
    if not cands:
        return [(0, len(text))]
    # cut[k]: matched pairs a boundary at candidate k would split
    n = len(cands)
    ends = [c.end for c in cands]
    steps = [0] * (n + 1)
    for a, b in _pairs(text):
        steps[bisect_right(ends, a)] += 1
        steps[bisect_right(ends, b)] -= 1
    cut = list(accumulate(steps))
    starts = [0, *(c.start for c in cands)]
    net = [c.score + CUT_SCORE * x for c, x in zip(cands, cut)]
    if all(x >= SURE or x <= 0 for x in net) and not any(c.short or c.lead for c in cands):
        used = [k for k, x in enumerate(net) if x > 0]  # lengths can't turn a sure boundary
        return list(zip([0, *(starts[k + 1] for k in used)], [*(ends[k] for k in used), len(text)]))
    words = [m.start() for m in _LENGTH_UNIT.finditer(text)]
    opens = [0.0, *(c.open for c in cands)]
    best, back, top = [0.0] * (n + 2), [0] * (n + 2), [0] * (n + 2)  # top[i]: the best node up to i, the first among equals
    for j in range(1, n + 2):
        end = ends[j - 1] if j <= n else len(text)
        close, limit = (cands[j - 1].close + CUT_SCORE * cut[j - 1], 2 if cands[j - 1].short else 1 if cands[j - 1].lead else 0) if j <= n else (0.0, 0)
        last = bisect_left(words, end)  # words before the span's end
        near = j
        while near and last - bisect_left(words, starts[near - 1]) <= 2:
            near -= 1
        found = (best[top[near - 1]] + opens[top[near - 1]], top[near - 1]) if near else (float("-inf"), 0)
        for i in range(near, j):
            size = max(1, last - bisect_left(words, starts[i]))
            value = best[i] + opens[i] + LENGTH_SCORES[size] + (SHORT_SCORE if size <= limit else 0.0)
            if value > found[0]:
                found = (value, i)
        best[j], back[j] = found[0] + close, found[1]
        far = top[j - 1]
        top[j] = j if j <= n and best[j] + opens[j] > best[far] + opens[far] else far
    out = []
    j = n + 1
    while j:
        i = back[j]
        out.append((starts[i], len(text) if j == n + 1 else ends[j - 1]))
        j = i
    return out[::-1]


def sentences(text: str | None) -> list[tuple[int, int]]:
    """Code-point offsets (start, end) of each sentence; none for null, empty and blank texts."""
    if not text:
        return []
    out, at = [], 0
    for piece in [*_BLANK.finditer(text), None]:
        stop = piece.start() if piece else len(text)
        unit = text[at:stop]
        left = len(unit) - len(unit.lstrip())
        core = unit.strip()
        if core:
            for a, b in _unit(core):
                x, y = at + left + a, at + left + b
                while y > x and text[y - 1].isspace():
                    y -= 1
                if y > x:
                    out.append((x, y))
        if piece:
            at = piece.end()
    return out


def _run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = [(doc, a, b) for doc, text in zip(pdf["doc_id"], pdf["text"]) for a, b in sentences(text)]
        yield pd.DataFrame(rows, columns=["doc_id", "sent_start", "sent_end"])


def split_sentences(documents: DataFrame) -> DataFrame:
    """(doc_id, sent_start, sent_end): every sentence of every document.

    Needs doc_id and text; further columns are ignored, repeated rows repeat their sentences.
    """
    rows = documents.select("doc_id", "text").where("text is not null")
    return rows.mapInPandas(_run, "doc_id bigint, sent_start bigint, sent_end bigint")
