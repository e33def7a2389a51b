"""Secret scans (operator 4): assignment-aware lexing.

Source and configuration text is lexed from each name on into name-literal pairs: assignments (``name =
"literal"``, ``name: type = ...``, ``"name" => 'literal'``) whose value is a string (plain, escaped, raw, over several
lines), strings joined by ``+``, a list of strings, a bare word or an indented YAML block; elements (``<name>literal</name>``),
options (``--name literal``) and arguments (``set("name", "literal")``). Constants are propagated: a value that
is the name of another binding - the last one before it, else the first one behind it - hands the target's
sensitivity on to that binding's literals, through any number of steps. Each literal is then scored by how
sensitive its target names are and how much it looks like key material; those
at or above ``THRESHOLD`` become spans of kind ``pair``. Three fixed patterns
(``assign``, ``access``, ``hex``) give the base spans, which always stay."""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketlens.llm.base import arrow_limits, position

KINDS = ("assign", "access", "hex", "pair")
THRESHOLD = 0.6


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# --- fixed values: the base patterns ---------------------------------------------
_NAMES = "|".join(map(_either_case, ("password", "passwd", "secret", "token"))) + "|" + _either_case("api") + "_?" + _either_case("key")
ASSIGN = re.compile(rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")   # runs are maximal, so shorter ones need no match

# --- the lexer -----------------------------------------------------------------
#: What may begin a pair: a name and a sign of assignment, an element, an option, or a name and the comma behind it in a call.
FORM = re.compile(r"""(?<![\w.\-])(?P<name>[A-Za-z_][\w.\-]*+)["']?[\x20\t]*(?P<sign>:=|=>|==?|:)[\x20\t]*"""
                  r"""|<(?P<element>[A-Za-z_][\w.\-:]*+)(?:\s[^<>]*+)?>\s*(?P<inside>[^<>]*[^<>\s])\s*</(?P=element)\s*>"""
                  r"""|(?<![\w\-])--(?P<option>[A-Za-z][\w.\-]*+)[\x20\t]+(?!-)"""
                  r"""|\(\s*+(?P<quote>["'])(?P<argument>[A-Za-z_][\w.\-]*+)(?P=quote)\s*+,\s*+(?=["'`])""", re.ASCII)
STRING = re.compile(r"""[rRbBfFuU]{0,2}(?:\"{3}(?P<a>.*?)\"{3}|'{3}(?P<b>.*?)'{3}|"(?P<c>(?:[^"\\\n]|\\.)*+)"|'(?P<d>(?:[^'\\\n]|\\.)*+)'|`(?P<e>[^`\n]*+)`)""", re.DOTALL)
BARE = re.compile(r"""[^\s"',;#(){}\[\]<>|+`][^\s"',;#(){}\[\]<>|`]*+""")
PLUS = re.compile(r"[\x20\t]*\+[\x20\t]*")
TYPED = re.compile(r"[\x20\t]*=(?!=)[\x20\t]*")
LIST = re.compile(r"[\[(]\s*+")
COMMA = re.compile(r"\s*+,\s*+")
BLOCK = re.compile(r"[|>][+-]?\d?[+-]?[\x20\t]*+\r?\n")
LINE = re.compile(r"([\x20\t]*+)([^\r\n]*+)(?:\r?\n|\r|\Z)")
IDENTIFIER = re.compile(r"[A-Za-z_][\w.]*", re.ASCII)
#: How sensitive the words of a name are.
SENSITIVE = {"password": 1.0, "passwd": 1.0, "pwd": 1.0, "passphrase": 1.0, "secret": 1.0, "token": 0.9,
             "apikey": 1.0, "credential": 0.9, "credentials": 0.9, "auth": 0.6, "authorization": 0.7, "bearer": 0.8,
             "private": 0.6, "signature": 0.4, "salt": 0.5, "pass": 0.8, "key": 0.4}
#: Pairs of words that say more together.
TOGETHER = {("api", "key"): 1.0, ("private", "key"): 1.0, ("access", "key"): 0.9, ("secret", "key"): 1.0,
            ("auth", "key"): 0.9, ("encryption", "key"): 0.9, ("signing", "key"): 0.9, ("session", "key"): 0.7}
_NEEDED = {*SENSITIVE, *(last for _, last in TOGETHER)}
#: A text without any of these has no sensitive name: each name that scores has one of them.
HINT = re.compile("|".join(sorted(w for w in _NEEDED if not any(o in w for o in _NEEDED - {w}))), re.IGNORECASE)
PLACEHOLDER = re.compile(r"(?i)change_?me|example[_-]?[a-z]*|placeholder|your[_-][a-z_-]*|dummy[_-]?[a-z]*|x{3,}|\*{3,}|todo|none|null|true|false|undefined"
                         r"|\$\{[^}]*\}?|\$\([^)]*\)?|%\w+%|\{\{.*?(?:\}\}|\Z)")
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")


def sensitivity(name: str) -> float:
    """0 to 1 by the words of a name (snake, kebab, dotted or camel case)."""
    words = [w.lower() for w in _WORDS.findall(name)]
    words = [w[:-1] if w not in SENSITIVE and w.endswith("s") else w for w in words]
    single = max((SENSITIVE.get(w, 0.0) for w in words), default=0.0)
    double = max((TOGETHER.get(p, 0.0) for p in zip(words, words[1:])), default=0.0)
    return max(single, double)


def _is_placeholder(literal: str) -> bool:
    """Words of a placeholder make up half of the literal or more; a long random one may hold some by chance."""
    return 2 * sum(m.end() - m.start() for m in PLACEHOLDER.finditer(literal)) >= len(literal)


def strength(literal: str) -> float:
    """0 to 1: how much a literal looks like key material."""
    if len(literal) < 6 or " " in literal.strip() or _is_placeholder(literal):
        return 0.0
    counts = Counter(literal).values()
    n = len(literal)
    bits = -sum(c / n * math.log2(c / n) for c in counts)
    classes = sum(bool(re.search(p, literal)) for p in ("[a-z]", "[A-Z]", "[0-9]", "[^A-Za-z0-9]"))
    return min(1.0, 0.35 + bits / 8 + 0.1 * (classes - 1))


@dataclass(slots=True)
class Binding:
    """A name, where it stands, and the spans bound to it; ``bare`` ones may be names themselves."""
    name: str
    at: int
    quoted: list[tuple[int, int]]
    bare: list[tuple[int, int]]


def _part(text: str, at: int, found: Binding) -> int:
    """Lexes one string or bare word; where it ends, -1 if there is none."""
    m = STRING.match(text, at)
    if m:
        found.quoted.append(m.span(m.lastgroup))
        return m.end()
    m = BARE.match(text, at)
    if m:
        found.bare.append(m.span())
        return m.end()
    return -1


def _value(text: str, at: int, found: Binding, typed: bool) -> int:
    """Lexes the value at ``at``. Where to look for the next name: behind bare words, but inside of strings."""
    block = BLOCK.match(text, at)
    if block:
        top, here = LINE.match(text, text.rfind("\n", 0, found.at) + 1), block.end()
        while here < len(text):
            line = LINE.match(text, here)
            if line[2] and len(line[1]) <= len(top[1]):
                break
            if line[2].strip():
                found.quoted.append((line.start(2), line.start(2) + len(line[2].rstrip())))
            here = line.end()
        return at + 1
    some = LIST.match(text, at)
    if some:
        here = some.end()
        while m := STRING.match(text, here):
            found.quoted.append(m.span(m.lastgroup))
            comma = COMMA.match(text, m.end())
            if not comma:
                break
            here = comma.end()
        return some.end()
    end = here = at
    while (here := _part(text, here, found)) >= 0:
        end = here
        plus = PLUS.match(text, end)
        if not plus:
            break
        here = plus.end()
    if typed and found.bare and not found.quoted and (m := TYPED.match(text, end)):
        found.bare.clear()
        return _value(text, m.end(), found, False)
    return at + 1 if found.quoted else max(end, at)


def bindings(text: str) -> list[Binding]:
    """All name-literal pairs of a text, in its order."""
    out, at = [], 0
    while m := FORM.search(text, at):
        name = m["name"] or m["element"] or m["option"] or m["argument"]
        found = Binding(name, m.start(), [], [])
        if m["element"]:
            found.quoted.append(m.span("inside"))
            at = m.start("inside")
        else:
            at = _value(text, m.end(), found, m["sign"] == ":")
        if found.quoted or found.bare:
            out.append(found)
        at = max(at, m.start() + 1)
    return out


def pairs(text: str) -> list[tuple[int, int, str, float]]:
    """``(start, end, name, score)`` of the literals bound to names, scored."""
    if not HINT.search(text):
        return []
    bound = bindings(text)
    places: dict[str, list[int]] = {}
    for i, b in enumerate(bound):
        places.setdefault(b.name, []).append(i)
    literals, meant = [], []
    for i, b in enumerate(bound):
        spans, others = list(b.quoted), []
        for s, e in b.bare:
            at = places.get(text[s:e], []) if IDENTIFIER.fullmatch(text, s, e) else []
            before = bisect_left(at, i)
            other = at[before - 1] if before else next((j for j in at[:2] if j != i), None)
            if other is None:
                spans += [(s, e)] * (text[s:e] != b.name)     # secret=secret says nothing
            else:
                others.append(other)
        literals.append(spans)
        meant.append(others)
    worth = [sensitivity(b.name) for b in bound]
    best: dict[tuple[int, int], tuple[float, str]] = {}
    seen = [False] * len(bound)
    for i in sorted(range(len(bound)), key=lambda i: -worth[i]):     # the most sensitive target reaches a binding first
        if not worth[i]:
            break
        waiting = [i]
        while waiting:
            j = waiting.pop()
            if seen[j]:
                continue
            seen[j] = True
            waiting += meant[j]
            for s, e in literals[j]:
                score = worth[i] * strength(text[s:e])
                if score > best.get((s, e), (0.0, ""))[0]:
                    best[s, e] = (score, bound[i].name)
    return [(s, e, name, round(score, 6)) for (s, e), (score, name) in best.items() if score >= THRESHOLD]


def scan(text: str) -> list[dict]:
    """All spans of a text by start, then kind as listed: dicts of ``kind,
    start, end`` (code points, end exclusive), ``value_start`` (where the
    secret itself begins), ``name`` and ``score``."""
    found = [("assign", m.start(), m.end(), m.start(2), m[1], 1.0) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [("access", m.start(), m.end(), m.start(), None, 1.0) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    found += [("hex", m.start(), m.end(), m.start(), None, 1.0) for m in HEX.finditer(text)]
    found += [("pair", s, e, s, name, score) for s, e, name, score in pairs(text)]
    found.sort(key=lambda x: (x[1], KINDS.index(x[0]), x[2]))
    keys = ("kind", "start", "end", "value_start", "name", "score")
    return [dict(zip(keys, x, strict=True)) for x in found]


def redact(text: str, spans: list[dict], mark: str) -> str:
    """The text with each secret value replaced by ``mark``; overlapping values become one."""
    out, at = [], 0
    for s, e in sorted((x["value_start"], x["end"]) for x in spans):
        if s >= at:
            out += [text[at:s], mark]
        at = max(at, e)
    return "".join(out) + text[at:]


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value_start", pa.int64()), ("name", pa.string()), ("score", pa.float64())])
SPANS = "array<struct<kind:string,start:bigint,end:bigint,value_start:bigint,name:string,score:double>>"


def secret_spans(docs: DataFrame, column: str = "text") -> DataFrame:
    """All columns of ``docs``, then ``secrets``: the spans of each whole text (a
    column of that name in the input is replaced). A null text counts as
    empty and has none. Rows are independent: repeated rows, ties, nulls in
    other columns and empty tables change nothing."""
    arrow_limits(docs.sparkSession)
    kept = [i for i, c in enumerate(docs.columns) if c.lower() != "secrets"]
    at = position(docs, column)
    flat = docs.toDF(*[f"_in{i}" for i in range(len(docs.columns))])
    names = [f"_in{i}" for i in kept]
    schema = type(flat.schema)([flat.schema[n] for n in names]).add("secrets", StructType.fromDDL(f"s {SPANS}")["s"].dataType)

    def run(batches):
        for batch in batches:
            spans = [scan(t) if t else [] for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in kept], pa.array(spans, pa.list_(_SPAN))], names=[*names, "secrets"])

    return flat.mapInArrow(run, schema).toDF(*[docs.columns[i] for i in kept], "secrets")


def redacted(docs: DataFrame, mark: str = "[REDACTED]", column: str = "text", length: str | None = "n_chars") -> DataFrame:
    """``docs`` with each secret value in ``column`` replaced by ``mark`` and the
    ``length`` column, if there is one, brought up to date. Same columns, same
    rows; texts without a secret, and null texts, stay as they are."""
    arrow_limits(docs.sparkSession)
    at = position(docs, column)
    size = position(docs, length) if length and any(c.lower() == length.lower() for c in docs.columns) else None
    flat = docs.toDF(*[f"_in{i}" for i in range(len(docs.columns))])

    def run(batches):
        for batch in batches:
            texts = batch.column(at).to_pylist()
            clean = [redact(t, s, mark) if t and (s := scan(t)) else t for t in texts]
            arrays = list(batch.columns)
            arrays[at] = pa.array(clean, pa.string())
            if size is not None:
                kind = arrays[size].type
                arrays[size] = pa.array([len(c) if c is not t else n for t, c, n in zip(texts, clean, arrays[size].to_pylist(), strict=True)], kind)
            yield pa.RecordBatch.from_arrays(arrays, names=batch.schema.names)

    return flat.mapInArrow(run, flat.schema).toDF(*docs.columns)


def digest(docs: DataFrame) -> DataFrame:
    """Per document: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_pair``."""
    from marketlens.llm.base import pick
    found = secret_spans(pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("bigint")))

    def of(*kinds):
        return F.filter("secrets", lambda s: s["kind"].isin(*kinds))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    return found.select("doc_id", *[F.size(of(k)).cast("bigint").alias(f"n_{k}") for k in KINDS[:3]],
                        F.sha2(joined(of(*KINDS[:3])), 256).alias("base_sha256"), joined(F.col("secrets")).alias("spans"),
                        F.size(of("pair")).cast("bigint").alias("n_pair"))
