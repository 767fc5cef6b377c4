"""Personal data, also disguised: transducers normalise a text and keep, for each character, the source characters it stands for.

Identifiers are detected in the text as it is (base) and in the normalised text, whose spans are mapped back. The
transducers undo look-alike letters, invisible characters, spelled digits, and written-out or bracketed "at" and "dot".
"""

from __future__ import annotations

import html
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from larkspan.llm.chunks import plain, slices
from larkspan.llm.common import whole_text

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i & 1:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @ back over the local part, then on over the domain: leftmost matches in linear time."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            last = m.end()
        at = text.find("@", max(at + 1, last))


def detect(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of each base match, by kind and then start."""
    out = [("email", a, b) for a, b in emails(text)]
    if not DIGIT.search(text):
        return out
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                out.append(("phone", *m.span()))
    return out


# Letters of other scripts that look like Latin ones, and the names of the digits.
LOOK_ALIKES = dict(zip("АВЕКМНОРСТУХаеорсухіјѕԁԛԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧονρυıⅼ", "ABEKMHOPCTYXaeopcyxijsdqwABEZHIKMNOPTYXovpuil", strict=True))
INVISIBLE = "­​‌‍⁠﻿"
DIGIT_NAMES = (
    ("zero", "oh", "null", "zéro", "cero"),
    ("one", "eins", "un", "uno"),
    ("two", "zwei", "zwo", "deux", "dos"),
    ("three", "drei", "trois", "tres"),
    ("four", "vier", "quatre", "cuatro"),
    ("five", "fünf", "cinq", "cinco"),
    ("six", "sechs", "seis"),
    ("seven", "sieben", "sept", "siete"),
    ("eight", "acht", "huit", "ocho"),
    ("nine", "neun", "neuf", "nueve"),
)
VALUE_OF = {name: str(d) for d, names in enumerate(DIGIT_NAMES) for name in names}
NAME = "|".join(sorted(VALUE_OF, key=lambda x: (-len(x), x)))
#: Seven digits at least, spelled or not, of which the first is spelled or follows a plus.
SPELLED = re.compile(rf"(?i)(?<!\w)(?:(?:plus[\s,.-]{{1,3}}|\+\s?)?(?:{NAME}))(?:[\s,.-]{{1,3}}(?:{NAME}|[0-9])(?!\w)|[\s,.-]{{1,3}}(?:dot|point|punkt|punto)(?!\w)){{6,}}")
#: The same with runs of figures between and after the names; `mixed` counts the digits.
MIXED = re.compile(rf"(?i)(?<!\w)(?:(?:plus[\s,.-]{{1,3}}|\+\s?)?(?:{NAME}))(?:[\s,.-]{{1,3}}(?:{NAME}|[0-9]++|dot|point|punkt|punto)(?!\w))++")
#: Both in lower-case text, a little wider and faster: what `disguised` looks for, if it has DIGITS parts at least.
SPELLED_LOW = re.compile(rf"(?<![a-z])(?:{NAME})(?:[\s,.-]{{1,3}}(?:{NAME}|[0-9]++|dot|point|punkt|punto))++")
SPELLED_PART = re.compile(rf"(?i)plus|\+|{NAME}|[0-9]|dot|point|punkt|punto")
DIGITS, FIGURES = 7, re.compile(r"[0-9]{2}")
OPEN, CLOSE = r"\s{0,3}[(\[{<]\s{0,3}", r"\s{0,3}[)\]}>]\s{0,3}"
AT = re.compile(rf"(?i){OPEN}(?:at|@|arroba)(?:{CLOSE})")
DOT = re.compile(rf"(?i){OPEN}(?:dot|\.|punkt|point|punto)(?:{CLOSE})")
BRACKETED = re.compile(r"(?i)[(\[{<]\s{0,3}(?:at|@|arroba|dot|\.|punkt|point|punto)\s{0,3}[)\]}>]")
#: The signs between a written-out local part and its domain. A bare number or address of figures after the word "at" is prose.
SIGN = re.compile(r"(?i)[ _-](?:at|arroba)[ _-](?![0-9]++(?:\.[0-9]++)++(?![\w-]|\.\w))| @ |@")
#: A label ends where a written-out sign begins, so that no text can be read in two ways.
LABEL = re.compile(r"(?i)(?:(?!-(?:dot|punkt|punto|at|arroba)[ _-])[a-z0-9-])++")
BETWEEN = re.compile(r"(?i)[ _-](?:dot|punkt|punto)[ _-]| \. |\.")
AFTER = re.compile(r"\w|@\w")
WRITTEN_PART = re.compile(r"(?i)[ _-](at|arroba|dot|punkt|punto)[ _-]| ([@.]) ")
#: What `disguised` looks for before the costlier written(): all that it can change holds one.
WORD_SIGN = re.compile(r"(?i)[ _-](?:dot|punkt|punto)[ _-]| @ | \. |[ _-](?:at|arroba)[ _-](?:(?!-(?:at|arroba)-)[a-z0-9-])++(?:\.[a-z0-9-]|-(?:dot|punkt|punto)[ _-])")
DOTTED = re.compile(r"(?i)(?<=[0-9])[ _-](?:dot|punkt|punto|point)[ _-](?=[0-9])")
PLUS = re.compile(r"(?i)(?<!\w)plus[ -]?(?=[0-9][0-9 ().-]{6})")
ENTITY = re.compile(r"(?i)&(?:#0*64|#x0*40|commat|#0*46|#x0*2e|period|#0*43|#x0*2b|plus);")
#: Digits among which O, o, I and l stand for 0 and 1.
SLIPPED = re.compile(r"(?<![A-Za-z0-9])\+?[0-9OoIl](?:[ ().-]{0,2}[0-9OoIl]){7,}(?![A-Za-z0-9])")
SLIP = re.compile(r"[0-9][OoIl]|[OoIl][0-9]")
ODD = re.compile(f"[{INVISIBLE}{''.join(LOOK_ALIKES)}٠-٩۰-۹०-९！-～\U0001d400-\U0001d7ff]")


class Tape:
    """A text with the source span of each of its characters."""

    def __init__(self, text: str):
        self.text, self.starts, self.ends = text, [*range(len(text))], [*range(1, len(text) + 1)]

    def copy(self) -> Tape:
        """A tape of its own; rewrite() puts new lists in place of the old ones."""
        out = Tape("")
        out.text, out.starts, out.ends = self.text, self.starts, self.ends
        return out

    def rewrite(self, edits: list[tuple[int, int, str]]) -> None:
        """Puts a string for each range; its characters stand for the range's source. The edits ascend without overlap."""
        out, starts, ends, last = [], [], [], 0
        for a, b, new in edits:
            out += [self.text[last:a], new]
            starts += self.starts[last:a]
            ends += self.ends[last:a]
            if b > a:
                starts += [self.starts[a]] * len(new)
                ends += [self.ends[b - 1]] * len(new)
            last = b
        self.text = "".join([*out, self.text[last:]])
        self.starts, self.ends = starts + self.starts[last:], ends + self.ends[last:]


def glyphs(tape: Tape) -> None:
    edits = []
    for m in ODD.finditer(tape.text):
        c = m[0]
        new = "" if c in INVISIBLE else LOOK_ALIKES.get(c) or unicodedata.normalize("NFKC", c)
        if len(new) == 1 and not new.isascii():
            new = str(unicodedata.digit(new, "")) or LOOK_ALIKES.get(new, new)
        if new != c and len(new) <= 1:
            edits.append((*m.span(), new))
    tape.rewrite(edits)


def entities(tape: Tape) -> None:
    tape.rewrite([(*m.span(), html.unescape(m[0])) for m in ENTITY.finditer(tape.text)])


def slips(tape: Tape) -> None:
    edits = []
    for m in SLIPPED.finditer(tape.text):
        if 2 * sum(c.isdigit() for c in m[0]) >= sum(c.isalnum() for c in m[0]):
            edits += [(i, i + 1, "0" if c in "Oo" else "1") for i, c in enumerate(m[0], m.start()) if c in "OoIl"]
    tape.rewrite(edits)


def before_sign(text: str, end: int, low: int) -> int:
    """Where the local part that ends at `end` begins, not before `low`; `end` if there is none. Runs of its characters may be joined by a written-out dot."""

    def run(k: int) -> int:
        while k > low and text[k - 1] in LOCAL:
            k -= 1
        return k

    start = run(end)
    while low < start < end and text[start - 1] == " ":
        # " dot ", or with another separator on one side, which then is among the run's characters
        if text[start - 5 : start].lower() in (" dot ", "_dot ", "-dot "):
            joint = start - 5
        elif text[start : start + 4].lower() in ("dot_", "dot-"):
            joint = start - 1
        else:
            break
        if joint <= low or (further := run(joint)) == joint:
            break
        start = further
    return start


def written(text: str) -> list[tuple[int, int]]:
    """Spans of addresses whose signs may be written out, from each sign to both sides, no further than the signs around it: linear in the text."""
    out, last = [], 0
    for m in SIGN.finditer(text):
        low, last = last, max(last, m.end())
        start = before_sign(text, m.start(), low)
        if start == m.start() or (start > low and (text[start - 1].isalnum() or text[start - 1] == "_")):
            continue
        label = LABEL.match(text, m.end())
        ends = []
        while label:
            dot = BETWEEN.match(text, label.end())
            label = dot and LABEL.match(text, dot.end())
            if label:
                ends.append(label.end())
        # the longest domain that no word runs on from
        end = next((e for e in reversed(ends) if not AFTER.match(text, e)), None)
        if end:
            out.append((start, end))
            last = max(last, end)
    return out


def signs(tape: Tape) -> None:
    tape.rewrite(sorted([(*m.span(), "@") for m in AT.finditer(tape.text)] + [(*m.span(), ".") for m in DOT.finditer(tape.text)]))
    edits = []
    for start, end in written(tape.text):
        inner = [*WRITTEN_PART.finditer(tape.text, start, end)]
        edits += [(*x.span(), "@" if (x[1] or x[2]).lower() in ("at", "arroba", "@") else ".") for x in inner]
    tape.rewrite(edits)
    tape.rewrite([(*m.span(), ".") for m in DOTTED.finditer(tape.text)])


def parts(found: str) -> int:
    """The names, figures and dots of spelled digits."""
    return sum(x.lower() not in ("plus", "+") for x in SPELLED_PART.findall(found))


def spelled(text: str) -> list[re.Match]:
    return [*SPELLED.finditer(text)]


def mixed(text: str) -> list[re.Match]:
    """Spelled digits with a run of figures among them."""
    return [m for m in MIXED.finditer(text) if FIGURES.search(m[0]) and sum(x.isdigit() or x.lower() in VALUE_OF for x in SPELLED_PART.findall(m[0])) >= DIGITS]


def digits(tape: Tape, found: list[re.Match]) -> None:
    edits = []
    for m in found:
        last = m.start()
        for x in SPELLED_PART.finditer(tape.text, m.start(), m.end()):
            if x.start() > last:
                edits.append((last, x.start(), ""))
            name = x[0].lower()
            edits.append((*x.span(), "+" if name == "plus" else VALUE_OF.get(name, name if len(name) == 1 else ".")))
            last = x.end()
        if m.end() > last:
            edits.append((last, m.end(), ""))
    tape.rewrite([e for e in edits if e[1] > e[0]])
    tape.rewrite([(*m.span(), "+") for m in PLUS.finditer(tape.text)])


def disguised(text: str) -> bool:
    if (not text.isascii() and ODD.search(text)) or BRACKETED.search(text) or any(parts(m[0]) >= DIGITS for m in SPELLED_LOW.finditer(text.lower())):
        return True
    if "&" in text and ENTITY.search(text):
        return True
    if DIGIT.search(text) and (SLIP.search(text) or PLUS.search(text) or DOTTED.search(text)):
        return True
    return bool(WORD_SIGN.search(text) and written(text))


def find(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and those that only the normalised text shows: they don't lie inside a base span of the kind."""
    base = detect(text)
    if not disguised(text):
        return base, []
    tape = Tape(text)
    for step in (entities, glyphs, signs):
        step(tape)
    # the base spans of a kind ascend without overlap
    held = {kind: ([a for k, a, _ in base if k == kind], [b for k, _, b in base if k == kind]) for kind in KINDS}
    more: dict[tuple[str, int, int], None] = {}
    # a run of figures may belong to the spelled digits before it or not: the text is read both ways
    readings = [spelled(tape.text), mixed(tape.text)]
    for found in readings if readings[1] else readings[:1]:
        own = tape.copy()
        digits(own, found)
        slips(own)
        for kind, a, b in detect(own.text) if own.text != text else ():
            start, end = own.starts[a], own.ends[b - 1]
            starts, ends = held[kind]
            at = bisect_right(starts, start) - 1
            if at < 0 or ends[at] < end:
                more[kind, start, end] = None
    return base, list(more)


SPANS = "array<struct<kind: string, start: int, end: int, base: boolean>>"
SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_())]))


def spans_column(text: Column) -> Column:
    """All spans of each text in code points, end exclusive, by kind and then start; a null counts as empty."""

    @F.arrow_udf(SPANS)
    def spans(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            rows = []
            for t in (t for part in slices(plain(texts), 1_000_000) for t in part.to_pylist()):
                base, more = find(t)
                both = [(k, a, b, True) for k, a, b in base] + [(k, a, b, False) for k, a, b in more]
                rows.append([dict(zip(("kind", "start", "end", "base"), x, strict=True)) for x in sorted(both, key=lambda x: (KINDS.index(x[0]), x[1]))])
            yield pa.array(rows, SPAN_TYPE)

    return spans(text)


def redact_column(text: Column) -> Column:
    """The text with [KIND] in place of each span; of overlapping ones the longest covers all. Null stays null."""

    @F.arrow_udf("string")
    def redacted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            rows = []
            for t in texts.to_pylist():
                if t is not None:
                    base, more = find(t)
                    out, last = [], 0
                    for kind, a, b in sorted(base + more, key=lambda x: (x[1], -x[2])):
                        if a >= last:
                            out += [t[last:a], f"[{kind.upper()}]"]
                        last = max(last, b)
                    t = "".join([*out, t[last:]])
                rows.append(t)
            yield pa.array(rows, pa.string())

    return redacted(text)


def scan_documents(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans (all).

    Null and empty texts have no spans; texts of any length are read whole, in time linear in their length. Repeated rows
    give repeated results, an empty table an empty one; other columns are ignored, whatever their names.
    """
    rows = docs.select("doc_id", spans_column(whole_text()).alias("found"))

    def count(kind: str) -> Column:
        return F.size(F.filter("found", lambda x: x["base"] & (x["kind"] == kind))).cast("bigint").alias(f"n_{kind}")

    def written(found: Column) -> Column:
        return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    return rows.select("doc_id", *map(count, KINDS), F.sha2(written(F.filter("found", lambda x: x["base"])), 256).alias("base_sha256"), written(F.col("found")).alias("spans"))
