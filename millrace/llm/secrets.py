"""Secret scan: fixed patterns, and literals that flow to names of secrets.

The second part lexes assignments of source and configuration files into names and values, follows
constants from name to name, and scores a literal by the name it ends up under and by its looks. A value
may span lines: triple quotes, backticks, YAML block scalars, XML elements. It hides no assignment inside it.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

KINDS = ("assign", "access", "hex", "literal")
_BASE = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I), 2, 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile(r"[0-9a-f]{32,}"), 0, 32),  # runs of 32 or more: a shorter run is never part of a longer match
)

# Words of names, with how much they say that the value is secret.
NAME_WEIGHT = {
    "password": 3.0, "passwd": 3.0, "passphrase": 3.0, "pwd": 3.0, "pass": 2.0, "secret": 3.0, "token": 2.5,
    "credential": 2.5, "credentials": 2.5, "apikey": 3.0, "auth": 1.5, "bearer": 2.0, "jwt": 2.0, "dsn": 1.5,
}
KEY_WEIGHT = {"api": 3.0, "access": 3.0, "private": 3.0, "signing": 3.0, "encryption": 3.0, "master": 2.5, "auth": 3.0}
NAME_PENALTY = {"name", "file", "path", "url", "uri", "count", "length", "type", "hint", "label", "prompt", "field", "policy", "public"}
PLACEHOLDER = re.compile(r"change.?me|example|placeholder|dummy|your|todo|x{4,}|\*{3,}|\.{3}|\$\{|\{\{|<[^>]*>|%\(", re.I)
THRESHOLD = 4.0

_STEMS = re.compile(r"pass|pwd|secret|token|api|key|credential|auth|bearer|jwt|dsn", re.I)
_NAME = r"[A-Za-z_$][\w$]*(?:(?:\.|->|-)[A-Za-z_$][\w$]*|\[[ \t]*[\"'][\w.\-]++[\"'][ \t]*+\])*"
_LONG = r"\"\"\"(?P<double>(?s:[^\"\\]|\\.|\"(?!\"\"))*+)\"\"\"|'''(?P<single>(?s:[^'\\]|\\.|'(?!''))*+)'''|`(?P<tick>[^`]*\n[^`]*)`"
_STRING = r"\"(?:[^\"\\\n]|\\.)*\"|'(?:[^'\\\n]|\\.)*'|`[^`\n]*`"
_OPERATOR = re.compile(r"(?<![=!<>:~]):=|(?<![=!<>:~])=>|(?<![=!<>:~])=(?![=~>])|(?<![:]):(?![:/=])")
# What stands before an operator is read backwards from it, so a name may be of any length: the patterns below are of
# reversed text. A name, in quotes or not, and perhaps a type after a colon.
_IDENTIFIER = r"[\w$]*[A-Za-z_$]"
_NAME_BACK = rf"(?:{_IDENTIFIER}(?:\.|>-|-)|\][ \t]*+[\"'][\w.\-]++[\"'][ \t]*+\[)*{_IDENTIFIER}"
_TARGET_BACK = re.compile(
    rf"\n?[ \t]*+(?:[\w.<>\[\]]*[A-Za-z_][ \t]*+:[ \t]*+)?(?P<quote>[\"']?)(?P<name>{_NAME_BACK})(?P=quote)", re.A
)
_TERM = re.compile(rf"(?P<long>{_LONG})|(?P<string>{_STRING})|(?P<ref>{_NAME})(?![\w(])", re.A)
_BLANKS = re.compile(r"[ \t]*")
_PLUS = re.compile(r"[ \t]*(?:\+|\.\.|&)[ \t]*(?:\\?\n[ \t]*)?")
_BARE = re.compile(r"[^\s\"'`#;,<>(){}\[\]]+(?=[ \t]*(?:$|[\r\n#;,<}]))")
_ELEMENT = re.compile(
    r"<(?P<name>[A-Za-z_][\w.\-]*+)(?:\s(?:[^<>\"']|\"[^\"<]*+\"|'[^'<]*+')*+)?>(?P<value>[^<>]++)</(?P=name)\s*+>", re.A
)
_BLOCK = re.compile(r"[|>][-+0-9]{0,2}[ \t]*(?:#[^\n]*)?\r?\n")
_INDENT = re.compile(r"[ ]*(?:-[ ]+)*")
_ARMOR = re.compile(r"-----(?:BEGIN|END) [A-Z0-9 ]+-----(?:\\r|\\n)*")  # lines around a PEM key
_WRAP = re.compile(r"\s*\n\s*")
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+", re.A)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of the fixed patterns; too short matches are dropped after matching."""
    return [
        (*m.span(), kind)
        for kind, pattern, group, least in _BASE
        if kind != "assign" or "=" in text or ":" in text
        for m in pattern.finditer(text)
        if len(m[group]) >= least
    ]


def name_score(name: str) -> float:
    parts = [w.lower() for w in _WORDS.findall(name)]
    score = max((NAME_WEIGHT.get(w, 0.0) for w in parts), default=0.0)
    pairs = zip(parts, parts[1:], strict=False)
    score = max([score, *(KEY_WEIGHT.get(a, 0.0) for a, b in pairs if b in ("key", "keys"))])
    return score - 2.0 * any(w in NAME_PENALTY for w in parts)


def literal_score(value: str) -> float:
    if len(value) < 6 or PLACEHOLDER.search(value):
        return -4.0
    n = len(value)
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(value).values())
    kinds = sum(any(test(c) for c in value) for test in (str.isdigit, str.islower, str.isupper))
    score = (n >= 8) + 0.5 * (n >= 16) + 0.5 * (entropy >= 3.0) + 0.5 * (kinds >= 2)
    return score - 2.0 * any(c.isspace() for c in value) - 1.0 * (kinds == 1 and value.isalpha())


def _long_kind(term: re.Match) -> str:
    return next(kind for kind in ("double", "single", "tick") if term[kind] is not None)


def _inner(text: str, start: int, end: int) -> tuple[int, int]:
    """The span without white space at both ends."""
    value = text[start:end]
    return end - len(value.lstrip()), start + len(value.rstrip())


def _block_scalar(text: str, key: int, start: int) -> tuple[int, int] | None:
    """The value of a YAML block scalar whose mark is at ``start``: the lines indented more than the key's at ``key``."""
    if not (mark := _BLOCK.match(text, start)):
        return None
    line = text.rfind("\n", 0, key) + 1
    indent = _INDENT.match(text, line).end() - line
    at = end = mark.end()
    while at < len(text):
        stop = text.find("\n", at) + 1 or len(text)
        row = text[at:stop]
        if row.strip():
            if len(row) - len(row.lstrip(" ")) <= indent:
                break
            end = stop
        at = stop
    first, last = _inner(text, mark.end(), end)
    return (first, last) if first < last else None


def literals(text: str) -> list[tuple[int, int, str, float]]:
    """``(start, end, name, score)`` of the literals that flow to a name of a secret, in order.

    Assignments are read once from the start; a name stands for what it was given last.
    """
    if not ("=" in text or ":" in text or "</" in text) or not _STEMS.search(text):
        return []
    known: dict[str, list[tuple[int, int]]] = {}
    found: dict[tuple[int, int], tuple[str, float]] = {}

    def settle(name: str, parts: list[tuple[int, int]]) -> None:
        last = re.split(r"\.|->", name)[-1]
        known[last] = known[name] = parts
        weight = name_score(name)
        if weight <= 0 or not parts:
            return
        value = _ARMOR.sub("", "".join(text[a:b] for a, b in parts))
        score = weight + literal_score(_WRAP.sub("", value))
        if score >= THRESHOLD:
            for part in parts:
                if part[0] < part[1] and score > found.get(part, ("", 0.0))[1]:
                    found[part] = (name, score)

    if "</" in text:
        for m in _ELEMENT.finditer(text):
            settle(m["name"], [_inner(text, *m.span("value")) if "\n" in m["value"] else m.span("value")])
    at = 0  # end of the last value read: operators inside it are text
    back = text[::-1]
    for operator in _OPERATOR.finditer(text):
        if operator.start() < at:
            continue
        target = _TARGET_BACK.match(back, len(text) - operator.start(), len(text) - at)
        if not target:
            continue
        name, begin = target["name"][::-1], len(text) - target.end()
        start = read = _BLANKS.match(text, operator.end()).end()
        parts: list[tuple[int, int]] = []
        if operator[0] == ":" and (block := _block_scalar(text, operator.start(), start)):
            settle(name, [block])
            continue
        while term := _TERM.match(text, read):
            if term["long"]:
                parts.append(_inner(text, *term.span(_long_kind(term))))
                read = term.end()
                at = max(at, term.start() + 1)
                if not (plus := _PLUS.match(text, read)):
                    break
                read = plus.end()
                continue
            if term["string"]:
                parts.append((term.start() + 1, term.end() - 1))
            elif term["ref"] in known:
                parts += known[term["ref"]]
            else:
                break
            at = read = term.end()
            if not (plus := _PLUS.match(text, read)):
                break
            read = plus.end()
        before = text[begin - 1 : begin] if begin else ""
        if not parts and before in ("", "\n", " ", "\t", "{", ",", ";"):
            if (bare := _BARE.match(text, start)) and not bare[0].isalpha():
                parts, at = [bare.span()], bare.end()
        settle(name, parts)
    return [(a, b, name, score) for (a, b), (name, score) in sorted(found.items())]


def spans(text: str | None) -> tuple[list, list]:
    """Base spans, and all spans: ``(start, end, kind)`` by start, then kind.

    A literal inside a base span is that finding already and not listed again.
    """
    text = text or ""
    order = lambda s: (s[0], KINDS.index(s[2]), s[1])
    base = sorted(base_spans(text), key=order)
    new = [(a, b, "literal") for a, b, _, _ in literals(text) if not any(s <= a and b <= e for s, e, _ in base)]
    return base, sorted(base + new, key=order)


def _joined(found: list) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in found)


def digest(docs: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` of every row, whole texts.

    A null text is empty: no spans, the digest of the empty string. Repeated rows are scanned each;
    other columns are not read; an empty table gives no rows.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text in batch.column(1):
                base, every = spans(text.as_py())
                n = Counter(kind for _, _, kind in base)
                out.append((n["assign"], n["access"], n["hex"], hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(every)))
            columns = list(zip(*out, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 3 + [pa.string()] * 2, strict=True))],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    schema = "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string"
    return docs.selectExpr("cast(doc_id as bigint)", "text").mapInArrow(scan, schema)


def findings(docs: DataFrame) -> DataFrame:
    """One row per span: ``doc_id, kind, start, end, found``, with the text found."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                {"doc_id": i.as_py(), "kind": kind, "start": a, "end": b, "found": t.as_py()[a:b]}
                for i, t in zip(batch.column(0), batch.column(1), strict=True)
                for a, b, kind in spans(t.as_py())[1]
            ]
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=shape)

    shape = pa.schema([("doc_id", pa.int64()), ("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("found", pa.string())])
    return docs.selectExpr("cast(doc_id as bigint)", "text").mapInArrow(
        scan, "doc_id bigint, kind string, start bigint, end bigint, found string"
    )
