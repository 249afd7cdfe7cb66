"""Secret scans: fixed patterns, and values in a credential's context judged by how many guesses they cost.

The guess cost of a value is the cheapest way to cut it into dictionary words, dates, repeats, keyboard walks and
brute-force spans, as the decimal logarithm of the guesses (dynamic programming over its positions). A value that costs
at least MIN_COST is a secret, even where the patterns do not know its name or signs.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weekmart.llm.text import prepare, column_udf

MIN_COST = 10.0
KINDS = ("assign", "access", "hex", "value")
SPAN = "struct<kind: string, start: int, end: int, cost: double>"
MASK = "[SECRET]"

#: The patterns of the base kinds, with the least length of what counts.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
ASSIGN_LENGTH, ACCESS_LENGTH = 8, 16

_NAME = r"(?:passw(?:or)?d|pass(?:phrase|code)?|pwd|secret|token|credentials?|auth(?:orization)?|bearer|(?:api|access|secret|private|client)[_-]?key)"
_VALUE = r"""(?:"((?:[^"\\\r\n]|\\.)+)"|'((?:[^'\\\r\n]|\\.)+)'|([^\s"'<>]+))"""
#: Names after which a value is judged by its cost: a quoted string with escapes, or signs up to white space, a quote or an angle
#: bracket; on the same line or indented on the next, after a command's option, or inside an element of that name.
CONTEXT = re.compile(
    rf"""{_NAME}["']?[\x20\t]*(?::=|=>|[:=])[\x20\t]*(?:\r?\n[\x20\t]+)?(?:(?:bearer|basic)\x20+)?{_VALUE}"""
    rf"""|--(?:[a-z0-9]+-)*{_NAME}(?:-[a-z0-9]+)*\x20+{_VALUE}"""
    rf"""|<(?:[a-z0-9]+[:_-])*{_NAME}>([^<>\r\n]+)</""", re.ASCII | re.IGNORECASE)
#: Where code goes on after a value: signs that close or end, another name with its value, a call.
CODE_TAIL = re.compile(r"""[)\]};,]*$|[,;&][\x20]*["']?[A-Za-z_][\w.-]*["']?[:=].*|[)\]}][.)\]};,\w(]*$""", re.ASCII)
OPENERS, CLOSERS = "([{", ")]}"
CALLS = ("('", '("', "['", '["')
CALL = re.compile(r"([A-Za-z_][\w.]*)\([^\s]*\)[.;,]*", re.ASCII)
ESCAPE = re.compile(r"\\(.)")

#: Common password words by falling frequency; a word's rank is its number of guesses.
COMMON_WORDS = """
password qwerty dragon monkey letmein football baseball master login welcome shadow sunshine princess admin
michael jordan superman batman trustno iloveyou love secret access hello freedom whatever test pass user guest root
summer winter spring autumn flower soccer hockey killer pepper ginger cookie silver golden orange purple yellow
blue green black white red house computer internet server database system default example changeme temp demo
private public token key value string none null true false your here this that the and for with from
""".split()
#: Short words of prose, and the words of which names in code are made, each by falling frequency as well.
SHORT_WORDS = "of to a in is i it on as at by or an be we if no my do so up he me us".split()
#: Words of which every sentence has some.
FUNCTION_WORDS = frozenset(SHORT_WORDS) | frozenset("the and you for with from that this your has have was are not over will can must been its".split())
SENTENCE_WORDS, FUNCTION_SHARE = 4, 0.2
CODE_WORDS = """
get set new old has use
auth authentication authorization authorize authenticate credential credentials bearer http https oauth jwt api url uri client
session cookie header request response config configuration settings setting options option env environment name id type data
provider manager service factory builder handler helper controller store storage vault cache context object class method function
create load read write find make build generate generator parse encode decode encrypt decrypt hash sign verify validate validator
aws azure google cloud github account application app model field form input output file path list map index current self
required optional missing invalid expired refresh reset change update error message text please include enter see chain
os sys env environ getenv var vars args argv params param str int val src bin lib etc usr opt tmp home root users documents desktop
downloads projects work ssl pem crt conf log logs local share static assets
""".split()

#: The other words: those of at least three letters that begin a word in this tokenizer of public_tokenizers, in the order of its merges.
WORD_FILE = "byte_bpe_50k.json"
KEY_ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
DATE = re.compile(r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d")
YEAR = re.compile(r"(?:19|20)\d\d")
DRIVE = re.compile(r"[A-Za-z]:(?=[\\/])")
#: Values that stand for another one: closed forms only, after an authorization scheme too; whatever else they hold is judged by its cost.
PLACEHOLDER = re.compile(
    r"(?:(?:bearer|basic)\s+)?(?:<[a-z][\w .:-]*>|\$\{[^{}]*\}|\$\([^()]*\)|\{\{[^{}]*\}\}|\{[a-z_][\w.]*\}|%[a-z_]\w*%|(?-i:\$_?[A-Z]+(?:_[A-Z0-9]+)*)|x+|\*+|\.+)",
    re.ASCII | re.IGNORECASE)
#: A URL's user and password are its value; what follows them is searched for contexts again.
URL = re.compile(r"[a-z][a-z0-9+.-]*://(?:([^/?#\s:]+:[^/\s]+|[^/?#\s]+)@)?", re.ASCII | re.IGNORECASE)

LETTER_COST, MIXED_COST, DIGIT_COST, SIGN_COST, SPAN_COST = 0.7, math.log10(36), 1.0, math.log10(33), 0.3
#: A word after a word tells about three quarters of what it tells alone; signs that join words and parts of paths, the same one mostly.
NEXT_WORD, JOINERS = 0.75, " -_./\\,:;()[]'\""
JOIN_COST = math.log10(len(JOINERS))
DATE_COST, YEAR_COST = math.log10(365 * 120), math.log10(120)


def _neighbours() -> set[tuple[str, str]]:
    """Pairs of keys side by side in a row, or on adjoining rows, and pairs that follow each other in the alphabet or count."""
    pairs = set()
    for above, row in zip(("",) + KEY_ROWS, KEY_ROWS):
        pairs |= set(zip(row, row[1:]))
        pairs |= {(a, b) for k, b in enumerate(row) for a in above[k: k + 2]}
    pairs |= {(chr(k), chr(k + 1)) for k in [*range(97, 122), *range(48, 57)]}
    return pairs | {(b, a) for a, b in pairs}


NEIGHBOURS = _neighbours()


class Words(NamedTuple):
    """Decimal logarithm of the guesses of each word, and the length of the longest."""

    costs: dict[str, float]
    longest: int


def ranked(*lists: Sequence[str]) -> Words:
    """Lists of words by falling frequency; a word's rank is its best one in a list."""
    costs: dict[str, float] = {}
    for words in lists:
        for k, w in enumerate(words):
            costs[w] = min(costs.get(w, math.inf), math.log10(k + 2))
    return Words(costs, max(map(len, costs), default=0))


@lru_cache(maxsize=1)
def known_words() -> Words:
    """The fixed words, and those of WORD_FILE; read on the driver, about 24,000 words whatever the input."""
    import public_tokenizers

    with open(public_tokenizers.path(WORD_FILE), encoding="utf-8") as file:
        ids = json.load(file)["model"]["vocab"]
    listed = (t[1:].lower() for t in sorted(ids, key=ids.get) if t[0] == "\u0120" and t[1:].isascii() and t[1:].isalpha() and len(t) > 3)
    return ranked(COMMON_WORDS, SHORT_WORDS, CODE_WORDS, list(dict.fromkeys(listed)))


class Cuts(NamedTuple):
    """Spans of a value that have a cost of their own, by their end: (start, cost); words and other ones; and its signs' costs."""

    words: list[list[tuple[int, float]]]
    others: list[list[tuple[int, float]]]
    signs: list[float]


def cuts(value: str, words: Words | None = None) -> Cuts:
    """Dictionary words, dates, keyboard walks and repeats in ``value``, and what each sign costs in a brute-force span."""
    ranks, longest = words or known_words()
    low, size = value.lower(), len(value)
    ends: list[list[tuple[int, float]]] = [[] for _ in range(size + 1)]
    word_ends: list[list[tuple[int, float]]] = [[] for _ in range(size + 1)]
    for a in range(size):
        for b in range(a + 1, min(size, a + longest) + 1):
            if (rank := ranks.get(low[a:b])) is not None:
                case = 0 if value[a:b] == low[a:b] else math.log10(2) if value[a:b].istitle() or value[a:b].isupper() else (b - a) * math.log10(2)
                word_ends[b].append((a, rank + case))
    if drive := DRIVE.match(value):
        word_ends[drive.end()].append((0, math.log10(26)))
    for pattern, cost in ((DATE, DATE_COST), (YEAR, YEAR_COST)):
        for a in range(size):
            if found := pattern.match(value, a):
                ends[found.end()].append((a, cost))
    a = 0
    while a < size:  # walks: maximal chains of neighbouring keys, three keys or more
        b = a + 1
        while b < size and (low[b - 1], low[b]) in NEIGHBOURS:
            b += 1
        if b - a >= 3:
            for end in range(a + 3, b + 1):
                ends[end].append((a, math.log10(47 * (end - a))))
        a = b if b > a + 1 else a + 1
    for unit in range(1, min(16, size // 2) + 1):  # repeats: maximal runs of a unit
        a = 0
        while a + 2 * unit <= size:
            b = a
            while b + unit < size and value[b] == value[b + unit]:
                b += 1
            times = (b - a) // unit + 1
            if times >= 2 and times * unit >= 3:
                ends[a + times * unit].append((a, unit * SIGN_COST + math.log10(times)))
            a = max(a + 1, b - unit + 1)

    def sign_cost(k: int) -> float:
        c = value[k]
        if c.isdigit():
            beside = (k and value[k - 1].isalpha()) or (k + 1 < size and value[k + 1].isalpha())
            return MIXED_COST if beside else DIGIT_COST
        if not c.isalpha():
            return SIGN_COST
        for j in (k - 1, k + 1):
            if 0 <= j < size and (value[j].isdigit() or (value[j].isalpha() and c.islower() and value[j].isupper() and j > k)):
                return MIXED_COST
        return LETTER_COST

    return Cuts(word_ends, ends, [sign_cost(k) for k in range(size)])


def guess_cost(value: str, words: Words | None = None) -> float:
    """Decimal logarithm of the guesses that the cheapest segmentation of ``value`` needs; the empty value costs 0.

    Letters next to letters of their own case cost less in a brute-force span than mixed ones, as language has fewer of
    them. A word that follows a word costs less than the first; between and after words, and before the first, signs that
    join words cost JOIN_COST, and nothing where one stands as well after the word before. Work and memory are in
    proportion to the value's length.
    """
    word_ends, ends, signs = cuts(value, words)
    size, inf = len(value), math.inf
    best, brute = [0.0] + [inf] * size, [inf] * (size + 1)
    worded: list[dict[str, float]] = [{"": inf}] + [{} for _ in range(size)]  # by the last joining sign
    for b in range(1, size + 1):
        brute[b] = min(brute[b - 1], best[b - 1] + SPAN_COST) + signs[b - 1]
        here = worded[b]
        for a, cost in word_ends[b]:
            here[""] = min(here.get("", inf), best[a] + SPAN_COST + cost)
            for sign, before in worded[a].items():
                here[sign] = min(here.get(sign, inf), before + NEXT_WORD * cost)
        if (c := value[b - 1]) in JOINERS:
            for sign, before in worded[b - 1].items():
                here[c] = min(here.get(c, inf), before + (0 if sign == c else JOIN_COST))
            if b == 1:
                here[c] = min(here.get(c, inf), SPAN_COST + JOIN_COST)
        best[b] = min([brute[b], *here.values(), *(best[a] + SPAN_COST + c for a, c in ends[b])])
    return best[size]


def is_sentence(value: str, words: Words | None = None) -> bool:
    """Whether a value is plain language: known words, at least four, a fifth of them such as every sentence has."""
    ranks = (words or known_words()).costs
    parts = [p.strip(".,;:!?'()").lower() for p in value.split()]
    known = [p for p in parts if p in ranks or p in FUNCTION_WORDS or p.removesuffix("s") in ranks or p.removesuffix("ed") in ranks or "'" in p and p.isascii()]
    return len(parts) >= SENTENCE_WORDS and len(known) == len(parts) and sum(p in FUNCTION_WORDS for p in parts) >= FUNCTION_SHARE * len(parts)


def _ends(text: str, start: int, end: int) -> list[int]:
    """Where an unquoted value may end, nearest first: before code that goes on after it, and at the white space.

    Code goes on at a bracket that nothing in the value opens, or at a sign outside brackets that begins another argument.
    Of a call the name alone is judged.
    """
    if call := CALL.fullmatch(text, start, end):
        return [call.end(1)]
    depth = 0
    for k in range(start, end):
        if text[k] in OPENERS:
            depth += 1
        elif text[k] in CLOSERS:
            depth -= 1
        if k > start and (depth < 0 or (depth == 0 and text[k] in ",;&")) and CODE_TAIL.fullmatch(text, k, end):
            return [k, end]
        depth = max(depth, 0)
    return [end]


def _context_values(text: str) -> Iterator[tuple[int, list[int], bool]]:
    """Starts and possible ends of the values in a credential's context, and whether they are quoted; of a URL its user and password.

    White space around a value is left out, as are calls with a quoted argument.
    """
    at = 0
    while found := CONTEXT.search(text, at):
        group = found.lastindex
        held, quoted = found[group], group % 3 != 0
        start = found.start(group) + len(held) - len(held.lstrip())
        end, at = start + len(held.strip()), found.end()
        if url := URL.match(text, start, end):
            at = url.end()
            if url[1]:
                yield url.start(1), [url.end(1)], quoted
        elif quoted:
            yield start, [end], True
        elif text[end - 1: end + 1] not in CALLS:
            ends = _ends(text, start, end)
            at = max(start + 1, ends[0])  # what goes on may hold another value
            yield start, ends, False


def find_secrets(text: str, min_cost: float = MIN_COST, words: Words | None = None) -> list[tuple[str, int, int, float]]:
    """Spans (kind, start, end, cost) of a text in code points, by start, then kind; base kinds first as the patterns give them."""
    spans = []
    for found in ASSIGN.finditer(text) if ":" in text or "=" in text else ():
        if len(found[2]) >= ASSIGN_LENGTH:
            spans.append(("assign", found.start(), found.end(), guess_cost(found[2], words)))
    spans += [("access", m.start(), m.end(), guess_cost(m[0], words)) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LENGTH]
    spans += [("hex", m.start(), m.end(), guess_cost(m[0], words)) for m in HEX.finditer(text)]
    base = list(spans)
    for start, ends, quoted in _context_values(text) if any(sign in text for sign in (":", "=", "--", "</")) else ():
        for end in ends:
            value = ESCAPE.sub(r"\1", text[start:end]) if quoted else text[start:end]
            if any(a <= start and end <= b for _, a, b, _ in base) or PLACEHOLDER.fullmatch(value) or is_sentence(value, words):
                continue
            if (cost := guess_cost(value, words)) >= min_cost:
                spans.append(("value", start, end, cost))
                break
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _masked(text: str, spans: list[tuple[str, int, int, float]]) -> str:
    parts, at = [], 0
    for _, start, end, _ in spans:
        if start >= at:
            parts += [text[at:start], MASK]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def with_spans(docs: DataFrame, text: str = "text", spans: str = "spans", min_cost: float = MIN_COST) -> DataFrame:
    """``docs`` with an array of secret spans: kind, start and end in code points (end exclusive) and guess cost.

    Null or empty text has an empty array. Kinds may overlap (a hex value that is also assigned); a value found by its
    context is left out only where one base span covers the whole of it. Repeated rows get equal arrays, a column of that
    name is replaced.
    """
    prepare(docs.sparkSession)
    words = docs.sparkSession.sparkContext.broadcast(known_words())

    def opened():
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("cost", pa.float64())]))
        names = ("kind", "start", "end", "cost")

        def apply(column: pa.Array) -> pa.Array:
            return pa.array([[dict(zip(names, s)) for s in find_secrets(t, min_cost, words.value)] if t else [] for t in column.to_pylist()], kind)
        return apply

    return docs.withColumn(spans, column_udf(f"array<{SPAN}>", opened)(docs[text]))


def masked_text(docs: DataFrame, text: str = "text", min_cost: float = MIN_COST) -> DataFrame:
    """``docs`` with every secret span of the text replaced by MASK, overlapping ones once; null stays null."""
    prepare(docs.sparkSession)
    words = docs.sparkSession.sparkContext.broadcast(known_words())

    def opened():
        return lambda column: pa.array([_masked(t, find_secrets(t, min_cost, words.value)) if t else t for t in column.to_pylist()], pa.string())

    return docs.withColumn(text, column_udf("string", opened)(docs[text]))


def joined(spans: Column, kinds: Sequence[str] = KINDS) -> Column:
    """The spans of the given kinds as kind:start:end, comma-joined."""
    chosen = F.filter(spans, lambda s: s["kind"].isin(list(kinds)))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
