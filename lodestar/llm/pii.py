"""Personal data in whole texts, found through disguises and reported in source offsets.

A text passes a chain of small transducers.  Each rewrites some spots (lookalike
characters, spelled digits, bracketed or spelled at signs and dots) and carries, for
every character of its output, the source characters that it stands for.  The
detectors run on the source and on the rewritten text; spans of the latter are
mapped back, so a match is always a range of the source's code points.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from bisect import bisect_right

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

# ---- detectors: leftmost, non-overlapping; a match that fails its check is dropped ----

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def emails(text: str) -> list[tuple[int, int]]:
    found, free = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, domain.end()))
        free = domain.end() if domain else at + 1
        at = text.find("@", free)
    return found


def ips(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _IP.finditer(text) if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or "0") <= 255 for part in m.group().split("."))]


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if k % 2 == 0 else (2 * n - 9 if n > 4 else 2 * n)
    return total % 10 == 0


def cards(text: str) -> list[tuple[int, int]]:
    found = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _NOT_DIGIT.sub("", m.group())
            if 13 <= len(digits) <= 19 and _luhn(digits):
                found.append(m.span())
    return found


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _PHONE.finditer(text) if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15]


_DETECT = {"email": emails, "ip": ips, "card": cards, "phone": phones}


def detect(text: str) -> dict[str, list[tuple[int, int]]]:
    """The spans of each kind in a plain text."""
    return {kind: find(text) for kind, find in _DETECT.items()}


# ---- transducers ----


class Mapped:
    """A text and, for each of its characters, the range of source characters it stands for."""

    def __init__(self, text: str, start: list[int], end: list[int]):
        self.text, self.start, self.end = text, start, end

    @classmethod
    def plain(cls, text: str) -> Mapped:
        return cls(text, list(range(len(text))), list(range(1, len(text) + 1)))

    def rewrite(self, edits: list[tuple[int, int, str]]) -> Mapped:
        """Replace ranges, given in order and without overlap; a replacement stands for all that it replaces."""
        if not edits:
            return self
        text, start, end, at = [], [], [], 0
        for lo, hi, new in edits:
            text += [self.text[at:lo], new]
            start += self.start[at:lo]
            end += self.end[at:lo]
            start += [self.start[lo]] * len(new)
            end += [self.end[hi - 1]] * len(new)
            at = hi
        text.append(self.text[at:])
        start += self.start[at:]
        end += self.end[at:]
        return Mapped("".join(text), start, end)

    def source(self, lo: int, hi: int) -> tuple[int, int]:
        return self.start[lo], self.end[hi - 1]


#: Letters of other alphabets that look like Latin ones.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "о": "o", "р": "p", "ԛ": "q", "ѕ": "s", "т": "t", "у": "y", "ѵ": "v", "ԝ": "w", "х": "x",
    "А": "A", "В": "B", "С": "C", "Е": "E", "Н": "H", "І": "I", "Ј": "J", "К": "K", "М": "M", "О": "O", "Р": "P", "Ѕ": "S", "Т": "T", "У": "Y", "Х": "X",
    "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
    "ı": "i", "ɡ": "g", "ɑ": "a", "ո": "n", "օ": "o", "ս": "u",
}


def _signs() -> dict[str, str]:
    """Digits of any script, compatibility forms of ASCII, dashes, spaces, dots; what is invisible goes."""
    table = {}
    for point in [*range(0x80, 0x3000), *range(0xA000, 0xB000), *range(0xFE50, 0xFFE0), *range(0x10000, 0x12000), *range(0x1D400, 0x1D800), *range(0x1FBF0, 0x1FBFA)]:
        c = chr(point)
        kind = unicodedata.category(c)
        folded = unicodedata.normalize("NFKC", c)
        if kind == "Nd":
            table[c] = str(unicodedata.digit(c))
        elif kind == "Pd":
            table[c] = "-"
        elif kind == "Zs":
            table[c] = " "
        elif kind == "Cf" and point in (0xAD, 0x200B, 0x200C, 0x200D, 0x200E, 0x200F, 0x2060, 0xFEFF):
            table[c] = ""
        elif len(folded) == 1 and "!" <= folded <= "~" and (point >= 0xFE50 or 0x2460 <= point < 0x2500 or point == 0x2024):
            table[c] = folded
    return table | {"　": " ", "−": "-", "。": ".", "｡": "."}


SIGNS = _signs()
_ODD = re.compile("[" + re.escape("".join(SIGNS)) + re.escape("".join(LOOKALIKES)) + "]")
_TOKEN = re.compile(r"\S+")


def fold_characters(m: Mapped) -> Mapped:
    """Lookalikes to ASCII: signs anywhere, letters only in a token that is otherwise ASCII and has a Latin letter or an at sign."""
    edits, upto, latin = [], 0, False
    for odd in _ODD.finditer(m.text):
        c, at = odd.group(), odd.start()
        if c in SIGNS:
            edits.append((at, at + 1, SIGNS[c]))
            continue
        if at >= upto:
            lo = at
            while lo and not m.text[lo - 1].isspace():
                lo -= 1
            token = _TOKEN.match(m.text, lo)
            upto, word = token.end(), token.group()
            others = [x for x in word if x > "~" and x not in SIGNS]
            latin = all(x in LOOKALIKES for x in others) and any("A" <= x <= "z" or x in "@@" for x in word)
        if latin:
            edits.append((at, at + 1, LOOKALIKES[c]))
    # a deletion must leave something to map to, so it joins the character before it
    merged: list[tuple[int, int, str]] = []
    for lo, hi, new in edits:
        if not new and merged and merged[-1][1] == lo:
            merged[-1] = (merged[-1][0], hi, merged[-1][2])
        elif not new and lo:
            merged.append((lo - 1, hi, m.text[lo - 1]))
        else:
            merged.append((lo, hi, new))
    return m.rewrite(merged)


_OPEN, _CLOSE, _GAP = r"[\[({<]", r"[\])}>]", r"[\s_-]{1,3}"
_DOT_WORDS = ("dot", "punkt", "punto", "point")
_DOT_WORD = f"(?:{'|'.join(_DOT_WORDS)})"
_BRACKETED = re.compile(rf"\s?{_OPEN}\s?(?:(at|ät|arroba|arobase|chez|@)|({_DOT_WORD}|\.))\s?{_CLOSE}\s?", re.IGNORECASE)
_MIDDLE_DOT = re.compile("(?<=[A-Za-z0-9])[·‧∙•](?=[A-Za-z])")
_SPACED_AT = re.compile(r"(?<=[A-Za-z0-9])(?:\s{1,2}@\s{0,2}|@\s{1,2})(?=[A-Za-z0-9-]+(?:\.|\s\.\s)[A-Za-z0-9])")
_SPACED_DOTS = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*(?P<dots>(?:\s\.\s[a-z0-9-]+)+)(?![A-Za-z0-9])")


def _lone_letters(text: str) -> list[tuple[int, int, str]]:
    """Edits that close up three or more single characters with a space between each two, in front of an at sign."""
    edits, at, floor = [], text.find("@"), 0
    while at >= 0:
        low = at - 1
        while low - 2 >= floor and text[low - 1] == " " and text[low] in _LOCAL and text[low - 2] in _LOCAL:
            low -= 2
        if low > floor and text[low - 1] in _LOCAL:  # the end of a longer word
            low += 2
        if low <= at - 5:
            edits += [(k, k + 2, text[k]) for k in range(low, at - 1, 2)]
        floor, at = at + 1, text.find("@", at + 1)
    return edits


def open_brackets(m: Mapped) -> Mapped:
    """``[at]``, ``(dot)`` and the like, middle dots in words, spaces around the at sign and the dots of an address or between the letters of its name."""
    m = m.rewrite([(*x.span(), "@" if x.group(1) else ".") for x in _BRACKETED.finditer(m.text)])
    m = m.rewrite([(*x.span(), ".") for x in _MIDDLE_DOT.finditer(m.text)])
    m = m.rewrite([(*x.span(), "@") for x in _SPACED_AT.finditer(m.text)])
    m = m.rewrite([(d.start() + x.start("dots"), d.end() + x.start("dots"), ".") for x in _SPACED_DOTS.finditer(m.text) for d in re.finditer(r"\s\.\s", x.group("dots"))])
    return m.rewrite(_lone_letters(m.text))


#: Names of digits.
DIGIT_WORDS = {
    "zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
    "oh": "0",
}
_WORDS = "|".join(sorted(DIGIT_WORDS, key=lambda w: -len(w)))
_SPELLED = re.compile(rf"(?<![^\W_])(?:(?:{_WORDS})(?![^\W\d_])|[0-9]+)", re.IGNORECASE)
_BETWEEN = re.compile(r"[\s,;/()_-]{1,3}\Z")
_LETTER_DIGITS = re.compile(r"(?<=[0-9])[OoIl]+(?=[0-9])")
_LETTER_QUAD = re.compile(r"(?<![A-Za-z0-9.])[0-9OoIl]{1,3}(?:\.[0-9OoIl]{1,3}){3}(?![A-Za-z0-9]|\.[A-Za-z0-9])")
_AS_DIGITS = {79: "0", 111: "0", 73: "1", 108: "1"}
_PLUS = re.compile(r"(?<![^\W_])plus[\s_-]{1,2}(?=[0-9])", re.IGNORECASE)
_DOT_IN_DIGITS = re.compile(rf"(?<=[0-9])(?:{_GAP}{_DOT_WORD}{_GAP}|\s\.\s)(?=[0-9])", re.IGNORECASE)


def read_digits(m: Mapped) -> Mapped:
    """Digit names next to another digit name, or between digits, to digits; runs of names close up."""
    items = [(x.start(), x.end(), x.group()) for x in _SPELLED.finditer(m.text)]
    spelled = [not "0" <= item[2][0] <= "9" for item in items]
    near = [lo - hi <= 3 and bool(_BETWEEN.match(m.text[hi:lo])) for (_, hi, _), (lo, _, _) in zip(items, items[1:], strict=False)]
    edits: list[tuple[int, int, str]] = []
    for k, (lo, hi, word) in enumerate(items):
        if not spelled[k]:
            continue
        before, after = k > 0 and near[k - 1], k + 1 < len(items) and near[k]
        if before and spelled[k - 1] or after and spelled[k + 1] or before and after:
            digit = DIGIT_WORDS[word.lower()]
            joined = edits and before and spelled[k - 1] and edits[-1][1] == items[k - 1][1]
            edits.append((items[k - 1][1] if joined else lo, hi, digit))
    m = m.rewrite(edits)
    m = m.rewrite([(*x.span(), x.group().translate(_AS_DIGITS)) for x in _LETTER_DIGITS.finditer(m.text)])
    quads = [x for x in _LETTER_QUAD.finditer(m.text) if sum(part.isdigit() for part in x.group().split(".")) >= 2]
    m = m.rewrite([(x.start() + k, x.start() + k + 1, c.translate(_AS_DIGITS)) for x in quads for k, c in enumerate(x.group()) if c in "OoIl"])
    m = m.rewrite([(*x.span(), "+") for x in _PLUS.finditer(m.text)])
    return m.rewrite([(*x.span(), ".") for x in _DOT_IN_DIGITS.finditer(m.text)])


_LABEL = r"[A-Za-z0-9]+(?:-[A-Za-z0-9]+)*?"
_CHAIN = re.compile(rf"(?:(?P<at>{_GAP}at{_GAP})|@)(?P<domain>{_LABEL}(?:\.{_LABEL}|{_GAP}{_DOT_WORD}{_GAP}{_LABEL})+)(?![A-Za-z0-9])", re.IGNORECASE)
_SAID_DOT = re.compile(rf"{_GAP}{_DOT_WORD}{_GAP}", re.IGNORECASE)
_SAID_BEFORE = re.compile(rf"{_GAP}(?:{'|'.join(w[::-1] for w in _DOT_WORDS)}){_GAP}(?=[A-Za-z0-9._%+-])", re.IGNORECASE)


def _name_start(text: str, back: str, floor: int, at: int) -> int:
    """Where the name that ends at ``at`` starts: a run of its characters and, before it, as often as they come, a spelled dot and another run.

    ``back`` is the text read from its end, so that a spelled dot is matched from the run leftwards.
    """
    low = at
    while True:
        run = low
        while run > floor and text[run - 1] in _LOCAL:
            run -= 1
        if run == low:
            return low
        said = _SAID_BEFORE.match(back, len(text) - run, len(text) - floor)
        if said is None:
            return run
        low = len(text) - said.end()


def join_addresses(m: Mapped) -> Mapped:
    """``name at host dot tld``: an at word counts where a dot is spelled too, or where the name has a digit or a sign in it.

    A name reaches back as far as its parts go, but not into the address before it.
    """
    edits: list[tuple[int, int, str]] = []
    text, back, floor = m.text, "", 0
    for x in _CHAIN.finditer(text):
        dots = [(d.start() + x.start("domain"), d.end() + x.start("domain"), ".") for d in _SAID_DOT.finditer(x.group("domain"))]
        at, own = x.start(), []
        back = back or text[::-1]
        low, floor = _name_start(text, back, floor, at), x.end()
        name = text[low:at]
        if not name:
            continue
        if x.group("at"):
            if not dots and not re.search(r"[0-9._%+]", name):
                continue
            own = [(*x.span("at"), "@")]
        said = [(d.start() + low, d.end() + low, ".") for d in _SAID_DOT.finditer(name)]
        edits += said + own + dots
    return m.rewrite(edits)


TRANSDUCERS = (fold_characters, open_brackets, read_digits, join_addresses)

#: Some spot that a transducer could rewrite; RE2 syntax, for whole batches at once.
_W2 = "|".join(sorted({w for w in DIGIT_WORDS if w != "oh"}, key=lambda w: -len(w)))
_TRIGGER = "(?i)" + "|".join(
    [
        "[" + "".join(f"\\x{{{ord(c):x}}}" for c in [*SIGNS, *LOOKALIKES]) + "]",
        rf"\b(?:{_W2})[\s,;/()_-]{{1,3}}(?:{_W2}|[0-9])",
        rf"[0-9][\s,;/()_-]{{1,3}}(?:{_W2})\b",
        rf"{_OPEN}\s?(?:at|ät|arroba|arobase|chez|@|{_DOT_WORD}|\.)\s?{_CLOSE}",
        rf"[\s_-]{_DOT_WORD}[\s_-]",
        r"[A-Za-z0-9](?:\s{1,2}@|@\s{1,2}[A-Za-z0-9])|@[A-Za-z0-9.-]+\s\.\s| [A-Za-z0-9._]@|[A-Za-z0-9][·‧∙•][A-Za-z]|[0-9]\.[0-9OoIl]*[OoIl]|\b[OoIl]+\.[0-9OoIl]",
        r"[0-9][OoIl]+[0-9]|\bplus[\s_-]{1,2}[0-9]|[0-9]\s\.\s[0-9]",
        r"[\s_-]at[\s_-]{1,3}[A-Za-z0-9-]+\.[A-Za-z]",
    ]
)


def through_disguises(text: str, base: dict[str, list[tuple[int, int]]]) -> dict[str, list[tuple[int, int]]]:
    """Spans that only the rewritten text shows: not inside a span of the same kind that the source shows."""
    m = Mapped.plain(text)
    for transducer in TRANSDUCERS:
        m = transducer(m)
    if m.text == text:
        return {}
    extra: dict[str, list[tuple[int, int]]] = {}
    for kind, spans in detect(m.text).items():
        starts = [s for s, _ in base[kind]]
        for lo, hi in spans:
            s, e = m.source(lo, hi)
            k = bisect_right(starts, s) - 1
            if text[s:e] != m.text[lo:hi] and not (k >= 0 and e <= base[kind][k][1]):
                extra.setdefault(kind, []).append((s, e))
    return extra


def find(texts: pa.Array) -> list[tuple[dict[str, list[tuple[int, int]]], dict[str, list[tuple[int, int]]]]]:
    """For each text its base spans and the spans added by the transducers."""
    none = {kind: [] for kind in KINDS}
    texts = pc.fill_null(texts, "")
    marked = pc.match_substring_regex(texts, "[0-9@]").to_pylist()
    odd = pc.match_substring_regex(texts, _TRIGGER).to_pylist()
    out = []
    for text, some, more in zip(texts, marked, odd, strict=True):
        if not some and not more:
            out.append((none, {}))
            continue
        text = text.as_py()
        base = detect(text) if some else none
        out.append((base, through_disguises(text, base) if more else {}))
    return out


def _joined(spans: dict[str, list[tuple[int, int]]]) -> str:
    return ",".join(f"{kind}:{s}:{e}" for kind in KINDS for s, e in sorted(spans.get(kind, ())))


def _union(base, extra):
    return {kind: sorted([*base.get(kind, ()), *extra.get(kind, ())]) for kind in KINDS}


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def pii_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added), one row for each row.

    Counts and digest are those of the plain spans; ``spans`` lists all, by kind and
    start, as ``kind:start:end`` in code points; ``n_added`` counts what the
    transducers add.  A null or empty text has none.  Other columns are ignored.
    """

    def run(batches):
        for batch in batches:
            found = find(batch.column(1))
            columns = [pa.array([len(base[kind]) for base, _ in found], pa.int64()) for kind in KINDS]
            digests = pa.array([hashlib.sha256(_joined(base).encode()).hexdigest() for base, _ in found], pa.string())
            spans = pa.array([_joined(_union(base, extra)) for base, extra in found], pa.string())
            added = pa.array([sum(map(len, extra.values())) for _, extra in found], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns, digests, spans, added], names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "n_added"])

    kind = docs.schema[id_col].dataType.simpleString()
    return _source(docs, id_col, text_col).mapInArrow(run, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")


def masked(text: str, spans: dict[str, list[tuple[int, int]]]) -> str:
    """The text with each span, or run of overlapping spans, replaced by the name of its first kind in brackets."""
    flat = sorted((s, -e, kind) for kind, found in spans.items() for s, e in found)
    out, at = [], 0
    for s, e, kind in flat:
        if s >= at:
            out += [text[at:s], f"[{kind.upper()}]"]
            at = -e
        elif -e > at:
            at = -e
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The same rows and columns with the personal data in ``text_col`` masked. A null text stays null."""
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            texts = batch.column(at)
            new = [t if t is None else masked(t, _union(*found)) if any(map(len, (*found[0].values(), *found[1].values()))) else t for t, found in zip(texts.to_pylist(), find(texts), strict=True)]
            yield batch.set_column(at, batch.schema.field(at).name, pa.array(new, pa.string()))

    return docs.mapInArrow(run, docs.schema)
