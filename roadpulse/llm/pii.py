"""Personal data: plain identifiers, and disguised ones found in a normalised copy of the text.

Plain identifiers (email, ip, card, phone) are found by their patterns in the text as it stands.
Disguised ones need a second look: transducers rewrite look-alike letters and digits of other scripts,
spelled digits ("five five five"), dot marks between groups of digits ("192[.]168 dot one dot 1") and spelled
marks ("name (at) host dot org") while keeping, for each character they write, the source characters it came
from. Whether a match counts depends on the match alone: with nothing but a plain " at " it needs one of
`ENDINGS` and a name that isn't one of `NO_NAMES`. The patterns then run over the rewritten
text, and each find that contains something rewritten and overlaps no plain find is mapped back.

Offsets are code points of the source, ends exclusive. Rows: a null text counts as empty and has no
finds. Repeated rows get equal results.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from hashlib import sha256

from pyspark.sql import DataFrame

from roadpulse.llm.text import map_rows, text_of

KINDS = ("email", "ip", "card", "phone")
RESULT = ("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, "
          "n_disguised long")
Span = tuple[str, int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9][0-9.]{6,}")
_IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Letters and digits that look like ASCII ones.
LOOK_ALIKES = {
    **dict(zip("авеікмнорсӏтухѕјԁһԛԝ", "abeikmhopcltyxsjdhqw")),   # Cyrillic, small
    **dict(zip("АВЕІКМНОРСТУХЅЈ", "ABEIKMHOPCTYXSJ")),             # Cyrillic, capital
    **dict(zip("αεικνορτυχ", "aeiknoptux")),                       # Greek, small
    **dict(zip("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "ABEZHIKMNOPTYX")),               # Greek, capital
    **{chr(0xFEE0 + c): chr(c) for c in range(0x21, 0x7F)},        # full width
    **{chr(0x660 + d): str(d) for d in range(10)},                 # Arabic-Indic digits
    **{chr(0x966 + d): str(d) for d in range(10)},                 # Devanagari digits
    **dict.fromkeys("\u2010\u2011\u2013", "-"), **dict.fromkeys("\u2024\u3002", "."),
    **dict.fromkeys("\u00a0\u2009\u202f", " "),
}
# Spelled digits.
SPELLED = {w: str(d) for d, words in enumerate((
    "zero oh", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine")) for w in words.split()}
_SPELLED_DIGIT = rf"(?:{'|'.join(SPELLED)})"
#: At least seven digits, spelled or not, with at least one spelled; single marks may stand between.
_SPELLED_RUN = re.compile(
    rf"(?i)(?<![\w+])(?:plus[ ])?(?:{_SPELLED_DIGIT}|[0-9]+)(?:[ \-.,]{{1,2}}(?:{_SPELLED_DIGIT}|[0-9]+)(?!\w))+")
_SPELLED_ONE = re.compile(rf"(?i)\b{_SPELLED_DIGIT}\b")
_WORD = r"[A-Za-z0-9_%+-]+"
_AT = r"(?:\s*[(\[{<]\s*(?:at|@)\s*[)\]}>]\s*|\s+at\s+|\s*@\s*)"
_DOT = r"(?:\s*[(\[{<]\s*(?:dot|\.)\s*[)\]}>]\s*|\s+dot\s+|\.)"
#: name at host dot ending; every mark may be spelled, in brackets or plain.
_SPELLED_MAIL = re.compile(rf"(?i)(?<![A-Za-z0-9_%+.-]){_WORD}(?:{_DOT}{_WORD})*?{_AT}[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)+")
# Endings that make "name at host dot ending" an address even without brackets.
ENDINGS = frozenset("com org net edu gov info io co de fr es uk eu it nl ch at us ca".split())
#: Words that stand before a plain " at " and a plain host in prose, as in "look at example.com".
NO_NAMES = frozenset((
    "is are was were be been it us me him them here there this that these those look looks looking looked see available "
    "found find hosted online located works worked working page site website and or not but as only now").split())
#: An at mark with a host behind it, as every match of `_SPELLED_MAIL` has; begins with a set, which is searched fast.
_MAIL_HINT = re.compile(
    rf"[aA@](?:(?<=@)|(?<=[\s(\[{{<][aA])[tT](?=[\s)\]}}>]))\s*(?:[)\]}}>]\s*)?[A-Za-z0-9-]+(?i:{_DOT})[A-Za-z0-9-]")
_DOT_HINT = re.compile(r"(?i)[(\[{<]\s*(?:dot|\.)\s*[)\]}>]|\sdot\s")
_TIGHT_DOT = re.compile(r"\.(?<=[A-Za-z0-9]\.)[A-Za-z0-9]")
_ONE = rf"(?:{_SPELLED_DIGIT}(?!\w))"
_NEXT = rf"[ \-]{{1,2}}(?:{_ONE}|[0-9](?!\w))"
#: Up to three digits of which one is spelled, or digits as they stand.
_GROUP = (rf"(?:(?<!\w)(?:{_ONE}(?:{_NEXT}){{0,2}}|[0-9][ \-]{{1,2}}{_ONE}(?:{_NEXT})?"
          rf"|[0-9][ \-]{{1,2}}[0-9][ \-]{{1,2}}{_ONE})(?![ \-]{{1,2}}{_ONE})|[0-9]+)")
#: At least four groups of digits, spelled or not, joined by dot marks.
_DOTTED_GROUPS = re.compile(rf"(?i)(?<![0-9]){_GROUP}(?:{_DOT}{_GROUP}){{3,}}")
_DOT_MARK = re.compile(rf"(?i){_DOT}")
_ALIKE_HINT = re.compile(f"[{re.escape(''.join(LOOK_ALIKES))}]")
_MARKS = re.compile(rf"(?i){_AT}|{_DOT}")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def find_emails(text: str) -> Iterator[Span]:
    """From each `@` outwards: the longest run before it, then the host. Linear in long runs."""
    free, at = 0, text.find("@")
    while at >= 0:
        begin = at
        while begin > free and text[begin - 1] in _LOCAL:
            begin -= 1
        found = _DOMAIN.match(text, at + 1) if begin < at else None
        free = found.end() if found else at + 1
        if found:
            yield "email", begin, free
        at = text.find("@", free)


def find_plain(text: str) -> list[Span]:
    """All plain finds, by kind as listed, then start."""
    out = list(find_emails(text))
    for run in _DOTTED.finditer(text):
        if run[0].count(".") >= 3:
            out += [("ip", m.start(), m.end()) for m in _IP.finditer(text, run.start(), run.end())
                    if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups())]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append(("phone", m.start(), m.end()))
    return out


class Rewritten:
    """A text and the source span of each of its characters; transducers compose.

    Characters are held as pieces: (start here, start in the source, end in the source, rewritten),
    one piece for each stretch that was copied and one for each that was written anew.
    """

    def __init__(self, text: str) -> None:
        self.text, self.pieces = text, [(0, 0, len(text), False)]
        self.starts = [0]

    def apply(self, edits: list[tuple[int, int, str]]) -> None:
        """Replace stretches [start, end) of the present text, in order and without overlap."""
        parts, pieces, at, length = [], [], 0, 0

        def copy(a: int, b: int) -> None:
            nonlocal length
            i = bisect_left(self.starts, a + 1) - 1
            while a < b:
                start, s, e, new = self.pieces[i]
                stop = self.starts[i + 1] if i + 1 < len(self.starts) else len(self.text)
                upto = min(b, stop)
                if upto > a:
                    pieces.append((length, s, e, True) if new else (length, s + a - start, s + upto - start, False))
                    parts.append(self.text[a:upto])
                    length += upto - a
                a, i = max(a, upto), i + 1

        for a, b, new in edits:
            copy(at, a)
            if new:
                (s, e), at_new = self.source(a, b), length
                pieces.append((at_new, s, e, True))
                parts.append(new)
                length += len(new)
            at = b
        copy(at, len(self.text))
        self.text, self.pieces = "".join(parts), pieces
        self.starts = [p[0] for p in pieces]

    def _at(self, a: int) -> int:
        return bisect_left(self.starts, a + 1) - 1

    def source(self, a: int, b: int) -> tuple[int, int]:
        """The source span of [a, b), which isn't empty."""
        start, s, _, new = self.pieces[self._at(a)]
        begin = s if new else s + a - start
        start, s, e, new = self.pieces[self._at(b - 1)]
        return begin, e if new else s + b - start

    def rewritten(self, a: int, b: int) -> bool:
        return any(self.pieces[i][3] for i in range(self._at(a), self._at(b - 1) + 1))


def dotted_groups(text: str, spelled: bool) -> list[tuple[int, int, str]]:
    """What to write for runs of digit groups whose digits or dots are disguised; `spelled`: has spelled digits.

    Where the dots are plain and only digits are spelled, the run must be one IP, as spelled numbers of
    other kinds may have dots between their digits.
    """
    if not (_DOT_HINT.search(text) or spelled and _TIGHT_DOT.search(text)):
        return []
    edits = []
    for run in _DOTTED_GROUPS.finditer(text):
        groups = [re.findall(r"[a-z]+|[0-9]+", g) for g in _DOT_MARK.sub("\n", run[0].lower()).split("\n")]
        written = ".".join("".join(SPELLED.get(t, t) for t in g) for g in groups)
        if "".join(m for m in _DOT_MARK.findall(run[0])).strip("."):
            edits.append((run.start(), run.end(), written))
        elif written != run[0] and len(groups) == 4 and text[max(0, run.start() - 5):run.start()].lower() != "plus ":
            if all(len(g) <= 3 and int(g) <= 255 for g in written.split(".")):
                edits.append((run.start(), run.end(), written))
    return edits


def normalise(text: str) -> Rewritten | None:
    """The text after all transducers; None if none of them has anything to rewrite."""
    out, changed = Rewritten(text), False
    if not text.isascii():
        edits = [(m.start(), m.end(), LOOK_ALIKES[m[0]]) for m in _ALIKE_HINT.finditer(text)]
        changed |= bool(edits)
        if edits:
            out.apply(edits)
    spelled = _SPELLED_ONE.search(out.text) is not None
    edits, free = dotted_groups(out.text, spelled), 0
    for begin, end in [(a, b) for a, b, _ in edits] + [(len(out.text), len(out.text))]:
        for run in _SPELLED_RUN.finditer(out.text, free, begin) if spelled else ():
            tokens = re.findall(r"[A-Za-z]+|[0-9]+", run[0])
            digits = sum(len(t) if t.isdigit() else t.lower() in SPELLED for t in tokens)
            if digits >= 7 and any(t.lower() in SPELLED for t in tokens):
                written = "".join("+" if t.lower() == "plus" else SPELLED.get(t.lower(), t) for t in tokens)
                edits.append((run.start(), run.end(), written))
        free = end
    changed |= bool(edits)
    if edits:
        out.apply(sorted(edits))
    edits = []
    if _MAIL_HINT.search(out.text):
        for mail in _SPELLED_MAIL.finditer(out.text):
            s, e = out.source(mail.start(), mail.end())
            if not re.search(r"[(\[{<@]", mail[0] + text[s:e]):
                words = mail[0].split()
                if words[-1].rpartition(".")[2].lower() not in ENDINGS:
                    continue
                if len(words) == 3 and words[0].lower() in NO_NAMES:
                    continue
            for m in _MARKS.finditer(out.text, mail.start(), mail.end()):
                mark = "@" if re.search(r"(?i)at|@", m[0]) else "."
                if m[0] != mark:
                    edits.append((m.start(), m.end(), mark))
    changed |= bool(edits)
    if edits:
        out.apply(edits)
    return out if changed else None


def find_disguised(text: str, plain: list[Span]) -> list[Span]:
    """Finds that only the rewritten text shows, as spans of the source; none that lies within a plain one."""
    out = normalise(text)
    if out is None:
        return []
    taken = {kind: sorted((s, e) for k, s, e in plain if k == kind) for kind in KINDS}   # of a kind none overlap
    found = []
    for kind, a, b in find_plain(out.text):
        if not out.rewritten(a, b):
            continue
        s, e = out.source(a, b)
        last = (spans[i - 1] for spans in taken.values() if (i := bisect_right(spans, (s, len(text)))))
        if not any(e <= end for _, end in last):
            found.append((kind, s, e))
    return found


def scan_text(text: str) -> tuple:
    """The columns of `RESULT` for one text."""
    plain = find_plain(text)
    extra = find_disguised(text, plain)
    order = {kind: i for i, kind in enumerate(KINDS)}
    spelled = lambda spans: ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(
        spans, key=lambda x: (order[x[0]], x[1])))
    return (*(sum(k == kind for k, _, _ in plain) for kind in KINDS),
            sha256(spelled(plain).encode()).hexdigest(), spelled(plain + extra), len(extra))


def scan(docs: DataFrame, columns: list[str]) -> DataFrame:
    """`columns` of `docs` and the columns of `RESULT`."""
    return map_rows(docs, columns, ["text"], RESULT, lambda text: scan_text(text_of(text)))
