"""Secret scans by assignment-aware lexing, beside three fixed patterns.

Fixed patterns (each leftmost, non-overlapping): ``assign``, ``access`` and
``hex``; see ``BASE``.

Method: around every assignment operator (``=``, ``:``, ``:=``, ``=>``) the text is
lexed as source or configuration: a name before it (bare, quoted, dotted,
optionally with a type after a colon) and an expression behind it (string
literals with their prefixes and escapes, names, bare values, joined by ``+``,
``.`` or standing next to each other), through brackets, call arguments and
continued lines; each argument or element is a value of its own, and keys that a
lookup is given are none. That gives pairs of a name and the literals that make
up its values. Names stand for the literals last assigned to
them, so constants are propagated through later assignments. A literal is
scored by how sensitive the words of its target's name are times its strength
(length times the entropy of its characters; placeholders have none; of PEM blocks,
URLs and phrases the secret part counts). From
MIN_SCORE on it is reported: as ``literal`` if it stands in the assignment
JOINED = 64             # literals that are joined into one value
itself, as ``flow`` if it came through another name.

A span is kind:start:end in code points, end exclusive. Texts are scanned one
by one, whole; nothing is shuffled, so no source or group can be hot.

Defined cases: null text counts as empty; an empty text has no spans; repeated
rows give repeated results; an empty table gives an empty result; extra columns
are not looked at."""

from __future__ import annotations

import math
import re
from collections import Counter
from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.common import rows_of, table, utf8_rows

# Fixed patterns of the contract; the check decides on each match.
BASE = (
    ("assign", re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
                          r"""([A-Za-z0-9+/_.=-]+)""", re.ASCII), lambda m: len(m[2]) >= 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
)
KINDS = ("assign", "access", "hex", "literal", "flow")

# Words of names and how sensitive a value of that name is.
SENSITIVE = {
    "apikey": 1.0, "auth": 0.6, "authorization": 0.8, "bearer": 0.9, "cred": 0.8, "credential": 0.9,
    "credentials": 0.9, "key": 0.5, "pass": 0.8, "passphrase": 1.0, "passwd": 1.0, "password": 1.0, "pin": 0.5,
    "pwd": 0.9, "secret": 1.0, "signature": 0.5, "token": 0.9,
}
# Pairs of words that stand next to each other in a name.
SENSITIVE_PAIRS = {
    ("access", "key"): 1.0, ("account", "key"): 1.0, ("api", "key"): 1.0, ("connection", "string"): 0.8,
    ("encryption", "key"): 1.0, ("private", "key"): 1.0, ("secret", "key"): 1.0, ("signing", "key"): 1.0,
}
# What stands where a secret would, in lower case.
PLACEHOLDERS = {
    "changeme", "default", "dummy", "example", "false", "foobar", "insert_here", "nil", "none", "null", "password",
    "placeholder", "redacted", "replace_me", "secret", "string", "test", "todo", "token", "true", "undefined",
    "unknown", "your_api_key", "your_password", "your_token",
}
# Words that say nothing in a value of several words.
FUNCTION_WORDS = frozenset("a an and are at be by can cannot do enter for from has have here if in invalid is it must "
                           "my new no not of on one or please should that the this to was with you your".split())
# Functions whose first argument is a key or a prompt, not a value.
LOOKUPS = {"config", "env", "environ", "fetch", "get", "getenv", "getpass", "getproperty", "input", "lookup", "pop",
           "prompt", "setdefault"}
WORD_BITS = 11.0        # of a plain word among several
MIN_SCORE = 0.5
JOINED = 64             # literals that are joined into one value
FULL_BITS = 40.0        # strength 1 from so many bits of entropy on
MIN_LITERAL = 6

_OPERATOR = re.compile(r":=|=>|[:=]")
_IDENT = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_.-$")
_NAME = re.compile(r"[A-Za-z_$][A-Za-z0-9_.$-]*")
_STRING = re.compile(r'''(?:[rbfuRBFU]{0,2})("""(?:[^\\]|\\.)*?"""|\'\'\'(?:[^\\]|\\.)*?\'\'\'|"(?:[^"\\\n]|\\.)*"|'''
                     r"""'(?:[^'\\\n]|\\.)*'|`[^`]*`)""", re.DOTALL)
_BARE = re.compile(r"""[^\s'"`;,()\[\]{}&|<>+]+""")
_PEM = re.compile(r"-----BEGIN [A-Z0-9 ]+-----(.*?)(?:-----END|\Z)", re.DOTALL)
_USERINFO = re.compile(r"://([^\s/?#@:]*)(?::([^\s/?#@]*))?@")
_GAP = re.compile(r"(?:[ \t\r\n]|\\\r?\n|(?:#|//)[^\n]*\n)*")         # within brackets
_NEXT_LINE = re.compile(r"[ \t]*(?:\\\r?\n[ \t]*|\r?\n[ \t]*(?=[rbfuRBFU]{0,2}['\"`]))")     # before the first term
_ASSIGNS = re.compile(r"[ \t]*(?::=|=>|=(?![=>])|:(?!:))")
_RANDOM = re.compile(r"(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9]+")     # a bare value, though a bracket follows
_CALLED = re.compile(r"([A-Za-z0-9_$]+)\Z")
_TYPED = re.compile(r"[ \t]*=(?!=)")
_BLANK = re.compile(r"[ \t]*")
_JOINT = re.compile(r"[ \t]*(?:\+[ \t]*(?:\\?\n[ \t]*)?|\.(?=[ \t'\"])[ \t]*)?")
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|[0-9]+")
_HEX_RUN = b"h" * 24
_HEX_CLASS = bytes(104 if c in b"0123456789abcdef" else 32 for c in range(256))


def base_spans(text: str, raw: bytes) -> list[tuple[str, int, int]]:
    """The spans of the fixed patterns. Texts that lack what a pattern needs (an
    operator, ``AKIA``, a run of 24 hex digits) are not searched for it."""
    out = []
    needs = (b":" in raw or b"=" in raw, b"AKIA" in raw, _HEX_RUN in raw.translate(_HEX_CLASS))
    for (kind, pattern, holds), there in zip(BASE, needs, strict=True):
        if there:
            out += [(kind, *m.span()) for m in pattern.finditer(text) if holds(m)]
    return out


def name_weight(name: str) -> float:
    words = [w.lower() for w in _WORDS.findall(name)]
    return max([SENSITIVE.get(w, 0.0) for w in words]
               + [SENSITIVE_PAIRS.get(p, 0.0) for p in zip(words, words[1:], strict=False)], default=0.0)


def strength(value: str) -> float:
    """0 to 1; 0 for short values, placeholders and references to other stores. Of a
    PEM block its body counts, of URLs the strongest password (or sole userinfo), of
    several words each one that is not a function word, placeholder or name of a secret."""
    pem = _PEM.search(value)
    if pem:
        return strength(re.sub(r"\s|\\[nrt]", "", pem[1]))
    if "://" in value:
        return max((strength(m[2] or m[1]) for m in _USERINFO.finditer(value)), default=0.0)
    low = value.lower()
    if (len(value) < MIN_LITERAL or low in PLACEHOLDERS or len(set(value)) < 4
            or re.search(r"\$\{|\{\{|%\(|^<.*>$|^\$", value)):
        return 0.0
    if " " in value:
        words = {w.strip(".,;:!?'\"()") for w in low.split()}
        bits = sum(WORD_BITS if w.isalpha() else _bits(w)
                   for w in words - PLACEHOLDERS - FUNCTION_WORDS - SENSITIVE.keys())
    else:
        bits = _bits(value)
        if value.isalpha() and (value.islower() or value.isupper() or value.istitle()):
            bits /= 2       # a plain word
    return min(1.0, bits / FULL_BITS)


def _bits(value: str) -> float:
    n = len(value)
    return -sum(c * math.log2(c / n) for c in Counter(value).values())


def _name_before(text: str, at: int) -> str | None:
    i = at
    while i and text[i - 1] in " \t":
        i -= 1
    quote = text[i - 1] if i and text[i - 1] in "\"'`" else ""
    i -= len(quote)
    j = i
    while j and text[j - 1] in _IDENT:
        j -= 1
    if quote and (not j or text[j - 1] != quote):
        return None
    name = text[j:i].lstrip("-.")
    return name if _NAME.fullmatch(name) else None


def _arguments(text: str, at: int, limit: int, called: str):
    """Terms within the bracket that opens at ``at``, a list for each argument; where they
    end; and if the bracket was closed. A setting of a sensitive name ends them before it
    (it is lexed by itself); other keywords and keys are passed over."""
    groups, group, depth = [], [], 0
    first = [called in LOOKUPS or (text[at] == "[" and called != "")]     # by open bracket: a key, not a value
    while at < limit:
        c = text[at]
        if c in "([":
            depth += 1
            if depth > 1:
                before = _CALLED.search(text, max(0, at - 64), at)
                first.append(bool(before) and (c == "[" or before[1].lower() in LOOKUPS))
            at += 1
        elif c in ")]":
            depth -= 1
            first.pop()
            at += 1
            if not depth:
                return [*groups, group], at, True
        elif c == ",":
            if group:
                groups.append(group)
            group, first[-1] = [], False
            at += 1
        elif c == "+":
            at += 1
        else:
            m = _STRING.match(text, at, limit)
            quote = 0
            if m:
                quote = 3 if m[1][:3] in ('"""', "'''") else 1
            else:
                m = _NAME.match(text, at, limit) or _BARE.match(text, at, limit)
                if not m or (not _NAME.fullmatch(m[0]) and (":" in m[0] or "=" in m[0])):
                    break
            a, z = (m.start(1) + quote, m.end(1) - quote) if quote else m.span()
            key = _ASSIGNS.match(text, m.end(), limit)
            if key:
                if name_weight(text[a:z]):
                    break
                at = key.end()
                first[-1] = first[-1] and text[a:z] != "default"
            else:
                if not first[-1]:
                    group.append(("lit" if quote else "arg", a, z))
                at = m.end()
        at = _GAP.match(text, at, limit).end()
    return [*groups, group], at, False


def _expression(text: str, at: int, limit: int):
    """Groups of terms from ``at`` on, of which each is one value: ("lit", start, end),
    ("ref", start, end) or, for names within brackets, ("arg", start, end); and where they end."""
    group, others = [], []
    at = (_NEXT_LINE.match(text, at, limit) or _BLANK.match(text, at, limit)).end()
    while True:
        m = _STRING.match(text, at, limit)
        if m:
            quote = 3 if m[1][:3] in ('"""', "'''") else 1
            group.append(("lit", m.start(1) + quote, m.end(1) - quote))
        elif at < limit and text[at] in "([":
            more, at, closed = _arguments(text, at, limit, "")
            if len(more) == 1:
                group += more[0]
            else:
                others += more
            if not closed:
                return [group, *others], at
        else:
            m = _BARE.match(text, at, limit)
            if not m:
                return [group, *others], at
            group.append(("ref" if _NAME.fullmatch(m[0]) else "lit", m.start(), m.end()))
        at = m.end() if m else at
        if group and group[-1][0] == "ref" and at < limit and text[at] in "([":
            name = text[group[-1][1]:at]
            more, at, closed = _arguments(text, at, limit, name.rpartition(".")[2].lower())
            others += more
            if not closed:
                return [group, *others], at
            if not _RANDOM.fullmatch(name):
                group.pop()     # a function's name
            m = None
        joint = _JOINT.match(text, at, limit)
        joined = joint[0].strip()
        if not joined and not (m and group and group[-1][0] == "lit" and _STRING.match(text, joint.end(), limit)):
            return [group, *others], at
        at = joint.end()


class _Values:
    """The values of a name: its own, each the literals that make it up, and those of
    the names in its assignment."""

    __slots__ = ("own", "earlier", "full", "tail", "weight")

    def __init__(self, own: list[tuple[tuple[int, int], ...]], earlier: list[_Values], full: list[_Values]):
        self.own, self.earlier, self.full = own, [*dict.fromkeys(earlier), *full], full
        # what a further literal is joined to: the only value, but for parts of it that are full
        self.tail = own[0] if len(own) == 1 and not earlier else None
        self.weight = 0.0       # of the most sensitive name that it was scored for

    def sensitive(self, text: str, weight: float):
        """The values that score under a name of this weight. Each is visited once for a
        weight: what scored under one before scores the same again."""
        todo = [self]
        while todo:
            at = todo.pop()
            if at.weight < weight:
                at.weight = weight
                for value in at.own:
                    if weight * strength("".join(text[a:z] for a, z in value)) >= MIN_SCORE:
                        yield value
                todo += at.earlier


def assigned_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of sensitive literals by name (``literal``) and by propagation (``flow``).

    Operators inside a literal (a setting within a string) are lexed within it, and
    what they assign is not searched again. A name refers to what the names in its
    assignment held, and that is scored once for each weight of a name; a value put
    together from over JOINED literals is not joined further but kept beside the
    next. So the time is linear in the text, whatever is assigned to what."""
    known: dict[str, _Values] = {}
    found: dict[tuple[int, int], str] = {}
    done, outer, outer_stop = 0, iter(()), 0
    inside = (0, 0)         # the literal of the outer expression that is at hand
    for m in _OPERATOR.finditer(text):
        at, end = m.span()
        if at < done or (m[0] == "=" and (text[end:end + 1] == "=" or text[at - 1:at] in ("=", "!", "<", ">"))) \
                or (m[0] == ":" and (text[end:end + 1] == ":" or text[at - 1:at] == ":" or text[end:end + 2] == "//")):
            continue
        name = _name_before(text, at)
        if not name:
            continue
        nested = at < outer_stop
        if nested:
            while inside[1] <= at and (more := next(outer, None)):
                inside = more[1:]
        limit = inside[1] if nested and inside[0] <= at < inside[1] else len(text)
        if nested and limit == len(text):
            continue        # between the terms of an expression
        groups, stop = _expression(text, end, limit)
        if m[0] == ":" and len(groups) == 1 and len(groups[0]) == 1 and groups[0][0][0] == "ref":
            typed = _TYPED.match(text, stop, limit)
            if typed:       # name: type = value
                done = typed.end()
                groups, stop = _expression(text, done, limit)
        if nested:
            done = stop
        else:
            outer, inside, outer_stop = iter(sorted(chain.from_iterable(groups), key=lambda t: t[1:])), (0, 0), stop
        values, own, earlier, full = [], set(), [], []
        for group in groups:
            value = []
            for kind, a, z in group:
                told = known.get(text[a:z].rpartition(".")[2]) if kind != "lit" else None
                if told is None:
                    if kind != "arg":
                        value.append((a, z))
                        own.add((a, z))
                elif told.tail is None:
                    earlier.append(told)
                elif len(told.tail) <= JOINED:
                    value += told.tail
                    full += told.full
                else:
                    full.append(told)
            if value:
                values.append(tuple(dict.fromkeys(value)))
        # what a name held before is referred to, not copied
        now = known[name.rpartition(".")[2]] = _Values(list(dict.fromkeys(values)), earlier, list(dict.fromkeys(full)))
        weight = name_weight(name)
        if not weight:
            continue
        for value in now.sensitive(text, weight):
            for span in value:
                if span in own:
                    found[span] = "literal"
                else:
                    found.setdefault(span, "flow")
    return [(kind, a, z) for (a, z), kind in found.items() if z > a]


def scan_text(text: str, raw: bytes | None = None) -> list[tuple[str, int, int]]:
    """All spans of a text by start, then kind as listed."""
    raw = text.encode() if raw is None else raw
    spans = base_spans(text, raw)
    if b"=" in raw or b":" in raw:
        spans += assigned_spans(text)
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, spans array<struct<kind, start, end>>) for every row of ``docs``."""
    shape = "doc_id bigint, spans array<struct<kind: string, start: bigint, end: bigint>>"

    def batches(it):
        import pyarrow as pa
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        for b in it:
            spans = [[{"kind": k, "start": a, "end": z} for k, a, z in scan_text(raw.decode(), raw)]
                     for raw in utf8_rows(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, kind)], names=["doc_id", "spans"])
    return rows_of(docs).mapInArrow(batches, shape)


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["kind"].isin("assign", "access", "hex"))

    def number(kind):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")
    return scan(table(spark, sf_dir, "documents")).select(
        "doc_id", number("assign").alias("n_assign"), number("access").alias("n_access"),
        number("hex").alias("n_hex"), F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(spans).alias("spans"))
