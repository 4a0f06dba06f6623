"""Secret scans (5): one minimised automaton for all rules, run over the bytes in one pass.

Each rule is a regular expression over bytes. The rules are compiled together: a Thompson
construction, subset construction over byte classes, then minimisation by partition refinement. The
result is a transition array and, for each state, a bit mask of the rules that have just matched.
Scanning is a loop over *positions* in which numpy advances thousands of text segments at a time.
Segments end after byte pairs that lead every state back to the start (most word ends), so no match
crosses them and long texts become many short lanes. Only segments in which some rule accepted
are walked again, with that rule's own anchored automaton, for the exact leftmost longest spans.

Defined results: a null text has no spans, like an empty one; spans are code-point offsets, end
exclusive, in order of start, then rule; spans of different rules may overlap; repeated rows are
scanned each for itself; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from seisflow.llm.common import append_columns, byte_view


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``least`` bytes are needed in the match, or in the value after ``[:=]`` if ``assigned``."""

    kind: str
    pattern: str
    least: int
    assigned: bool = False


def any_case(word: str) -> str:
    """A pattern for an ASCII word in either case."""
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else c for c in word)


KEYWORDS = ("password", "passwd", "secret", "token", "api_?key")

# A key that is cut off before its end line matches by its header alone.
PEM_BODY = "[\r\n]*(Proc-Type: 4,ENCRYPTED[\r\n]+DEK-Info: [A-Z0-9-]+,[0-9A-F]+)?[A-Za-z0-9+/=\r\n]*"

# Formats of well-known credentials. The first three kinds are the base rules.
RULES = (
    Rule("assign", f"({'|'.join(map(any_case, KEYWORDS))})[\"']? *[:=] *[\"']?[A-Za-z0-9+/_.=-]+", 12, True),
    Rule("access", "AKIA[A-Z0-9]+", 18),
    Rule("hex", "[0-9a-f]{16,}", 16),
    Rule("github", "gh[oprsu]_[A-Za-z0-9]+", 40),
    Rule("pem", f"-----BEGIN [A-Z ]*PRIVATE KEY-----({PEM_BODY}-----END [A-Z ]*PRIVATE KEY-----)?", 27),
)
BASE = ("assign", "access", "hex")


class _Parser:
    """Patterns to an NFA: literals, classes with ranges, groups, ``|``, and ``? * + {m} {m,}``."""

    def __init__(self) -> None:
        self.empty: list[list[int]] = []
        self.edges: list[list[tuple[frozenset[int], int]]] = []

    def state(self) -> int:
        self.empty.append([])
        self.edges.append([])
        return len(self.empty) - 1

    def compile(self, pattern: str) -> tuple[int, int]:
        self.text, self.at = pattern, 0
        tree = self.alternatives()
        if self.at != len(pattern):
            raise ValueError(f"unbalanced pattern: {pattern}")
        return self.build(tree)

    def alternatives(self) -> tuple:
        options = [self.sequence()]
        while self.text[self.at:self.at + 1] == "|":
            self.at += 1
            options.append(self.sequence())
        return ("or", options)

    def sequence(self) -> tuple:
        parts = []
        while self.at < len(self.text) and self.text[self.at] not in "|)":
            parts.append(self.repeated(self.atom()))
        return ("seq", parts)

    def atom(self) -> tuple:
        c = self.text[self.at]
        self.at += 1
        if c == "(":
            inner = self.alternatives()
            self.at += 1
            return inner
        if c == "[":
            end = self.text.index("]", self.at)
            body, self.at, i, found = self.text[self.at:end], end + 1, 0, set()
            while i < len(body):
                if body[i + 1:i + 2] == "-" and i + 2 < len(body):
                    found.update(range(ord(body[i]), ord(body[i + 2]) + 1))
                    i += 3
                else:
                    found.add(ord(body[i]))
                    i += 1
            return ("set", frozenset(found))
        return ("set", frozenset([ord(c)]))

    def repeated(self, tree: tuple) -> tuple:
        c = self.text[self.at:self.at + 1]
        if c and c in "?*+":
            self.at += 1
            return ("rep", tree, {"?": 0, "*": 0, "+": 1}[c], c == "?")
        if c == "{":
            end = self.text.index("}", self.at)
            least, comma, _ = self.text[self.at + 1:end].partition(",")
            self.at = end + 1
            return ("rep", tree, int(least), None if not comma else False)
        return tree

    def build(self, tree: tuple) -> tuple[int, int]:
        start, kind = self.state(), tree[0]
        if kind == "set":
            end = self.state()
            self.edges[start].append((tree[1], end))
        elif kind == "seq":
            end = start
            for part in tree[1]:
                a, b = self.build(part)
                self.empty[end].append(a)
                end = b
        elif kind == "or":
            end = self.state()
            for part in tree[1]:
                a, b = self.build(part)
                self.empty[start].append(a)
                self.empty[b].append(end)
        else:
            _, inner, least, once = tree
            end = start
            for _ in range(least):
                a, b = self.build(inner)
                self.empty[end].append(a)
                end = b
            if once is not None:
                a, b = self.build(inner)
                last = self.state()
                self.empty[end] += [a, last]
                self.empty[b] += [last] if once else [a, last]
                end = last
        return start, end


@dataclass(frozen=True)
class Automaton:
    """``next[state * n_classes + class_of[byte]]``; state 0 starts; ``accepts`` holds rule bits."""

    class_of: np.ndarray
    next: np.ndarray
    accepts: np.ndarray
    n_classes: int
    dead: int  # -1 when every state can still match

    @property
    def resets(self) -> np.ndarray:
        """[class, next class]: True if the two bytes lead every state to the start, so that no match goes on."""
        table = self.next.reshape(-1, self.n_classes)
        return np.stack([(table[np.unique(table[:, c])] == 0).all(axis=0) for c in range(self.n_classes)])


def build_automaton(patterns: list[str], anchored: bool) -> Automaton:
    """Subset construction over byte classes, then minimisation by refining equal-behaviour blocks."""
    nfa = _Parser()
    starts, ends = zip(*(nfa.compile(p) for p in patterns))

    sets = sorted({s for e in nfa.edges for s, _ in e}, key=sorted)
    signature = [tuple(b in s for s in sets) for b in range(256)]
    kinds = {k: i for i, k in enumerate(dict.fromkeys(signature))}
    class_of = np.array([kinds[k] for k in signature], np.uint8)
    sample = [int(np.argmax(class_of == i)) for i in range(len(kinds))]

    def closure(states: set[int]) -> frozenset[int]:
        """With all that empty moves reach; only states that read a byte or end a rule matter."""
        seen, todo = set(states), list(states)
        while todo:
            for t in nfa.empty[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(s for s in seen if nfa.edges[s] or s in ends)

    # Where each NFA state goes on each byte class, empty moves included.
    moves = [[frozenset().union(*(closure({t}) for on, t in edges if b in on)) for b in sample] for edges in nfa.edges]
    first = closure(set(starts))
    again = frozenset() if anchored else first
    number, todo, rows = {first: 0}, [first], []
    for now in todo:  # grows while it is read
        row = []
        for k in range(len(sample)):
            to = again.union(*(moves[s][k] for s in now))
            if to not in number:
                number[to] = len(number)
                todo.append(to)
            row.append(number[to])
        rows.append(row)
    table = np.array(rows, np.int64)
    accepts = np.array([sum(1 << i for i, e in enumerate(ends) if e in s) for s in number], np.uint32)

    block = np.unique(accepts, return_inverse=True)[1]
    while True:  # states stay together while they accept alike and lead to the same blocks
        refined = np.unique(np.column_stack([block, block[table]]), axis=0, return_inverse=True)[1].ravel()
        if refined.max() == block.max():
            break
        block = refined
    order = {b: i for i, b in enumerate(dict.fromkeys(block.tolist()))}  # the start's block becomes 0
    block = np.array([order[b] for b in block.tolist()])
    keep = np.array([int(np.argmax(block == i)) for i in range(len(order))])
    small, acc = block[table[keep]], accepts[keep]
    dead = [i for i in range(len(keep)) if not acc[i] and (small[i] == i).all()]
    return Automaton(class_of, small.astype(np.int32).ravel(), acc, len(kinds), dead[0] if dead else -1)


@lru_cache(maxsize=8)
def automata(rules: tuple[Rule, ...]) -> tuple[Automaton, list[Automaton]]:
    """(all rules, matching anywhere), and each rule anchored at its start."""
    return build_automaton([r.pattern for r in rules], False), [build_automaton([r.pattern], True) for r in rules]


def accepted_segments(data: np.ndarray, offsets: np.ndarray, dfa: Automaton) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, rule bits) of the segments in which a rule accepts: one pass over all bytes."""
    classes = dfa.class_of[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[2:] = dfa.resets.ravel()[classes[:-1].astype(np.int32) * dfa.n_classes + classes[1:]] if len(data) else False
    cut[offsets] = True
    cuts = np.flatnonzero(cut)
    starts, lengths = cuts[:-1], np.diff(cuts)
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    state, bits = np.zeros(len(starts), np.int32), np.zeros(len(starts), np.uint32)
    alive = np.searchsorted(-lengths, -np.arange(1, (lengths[0] if len(lengths) else 0) + 1), side="right")
    for t, m in enumerate(alive.tolist()):
        now = dfa.next[state[:m] * dfa.n_classes + classes[starts[:m] + t]]
        state[:m] = now
        bits[:m] |= dfa.accepts[now]
    hit = np.flatnonzero(bits)
    hit = hit[np.argsort(starts[hit])]
    return starts[hit], starts[hit] + lengths[hit], bits[hit]


def value_length(found: bytes) -> int:
    """Length of what follows ``[:=]``, blanks and one quote in an assignment."""
    at = min(i for i in (found.find(b":"), found.find(b"=")) if i >= 0)
    value = found[at + 1:].lstrip(b" ")
    return len(value) - (value[:1] in (b'"', b"'"))


def matches(part: bytes, rule: Rule, dfa: Automaton) -> list[tuple[int, int]]:
    """Leftmost longest non-overlapping matches; those that are too short are dropped after they were consumed."""
    classes, step, accepts, n, out, i = dfa.class_of[np.frombuffer(part, np.uint8)].tolist(), dfa.next, dfa.accepts, dfa.n_classes, [], 0
    opening = (step[:n] != dfa.dead)
    while i < len(classes):
        if not opening[classes[i]]:
            i += 1
            continue
        state, end = 0, 0
        for j in range(i, len(classes)):
            state = int(step[state * n + classes[j]])
            if state == dfa.dead:
                break
            if accepts[state]:
                end = j + 1
        if not end:
            i += 1
            continue
        found = part[i:end]
        if (value_length(found) if rule.assigned else end - i) >= rule.least:
            out.append((i, end))
        i = end
    return out


def scan_texts(data: np.ndarray, offsets: np.ndarray, rules: tuple[Rule, ...], compiled: tuple) -> dict[int, list[tuple[int, int, int]]]:
    """By text number: (start, rule number, end) in code points, sorted. ``compiled``: ``automata(rules)``."""
    both, single = compiled
    found: dict[int, list[tuple[int, int, int]]] = {}
    for a, b, bits in zip(*(x.tolist() for x in accepted_segments(data, offsets, both))):
        part = data[a:b].tobytes()
        for k, rule in enumerate(rules):
            if bits >> k & 1:
                for s, e in matches(part, rule, single[k]):
                    doc = int(np.searchsorted(offsets, a + s, side="right")) - 1
                    found.setdefault(doc, []).append((a + s, k, a + e))
    for doc, spans in found.items():
        base = int(offsets[doc])
        points = np.concatenate([[0], np.cumsum((data[base:offsets[doc + 1]] & 0xC0) != 0x80)])
        found[doc] = sorted((int(points[s - base]), k, int(points[e - base])) for s, k, e in spans)
    return found


SPAN = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_ARROW_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def find_secrets(docs: DataFrame, text_col: str = "text", out: str = "spans", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with ``out``: array of (kind, start, end) over the whole text."""
    compiled = automata(rules)  # built once on the driver; tasks get the arrays

    def make(texts: pa.Array) -> list[pa.Array]:
        data, offsets = byte_view(texts)
        found = scan_texts(data, offsets, rules, compiled)
        return [pa.array([[{"kind": rules[k].kind, "start": s, "end": e} for s, k, e in found.get(i, ())] for i in range(len(texts))], _ARROW_SPAN)]

    return append_columns(docs, text_col, [T.StructField(out, SPAN)], make)


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """The text with each maximal run of overlapping or touching spans replaced by ``mark``.

    Spans are sorted by start, so one fold keeps the text built so far and the end of what was read.
    """
    state = F.struct(F.lit("").alias("made"), F.lit(0).cast("long").alias("at"))

    def step(acc: Column, span: Column) -> Column:
        fresh = (span["start"] > acc["at"]) | (acc["at"] == 0)
        before = F.substring(text, (acc["at"] + 1).cast("int"), F.greatest(span["start"] - acc["at"], F.lit(0)).cast("int"))
        return F.struct(F.when(fresh, F.concat(acc["made"], before, F.lit(mark))).otherwise(acc["made"]).alias("made"),
                        F.greatest(acc["at"], span["end"]).alias("at"))

    rest = lambda acc: F.concat(acc["made"], F.substring(text, (acc["at"] + 1).cast("int"), F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, state, step, rest)).otherwise(text)


def redact_secrets(docs: DataFrame, text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret in ``text_col`` replaced by ``mark``; all other columns unchanged."""
    found = find_secrets(docs, text_col, "__spans")
    return found.withColumn(text_col, redacted(F.col(text_col), F.col("__spans"), mark)).select(*[F.col(f"`{c}`") for c in docs.columns])


def span_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_digests(docs: DataFrame) -> DataFrame:
    """One row per document: counts of the base kinds, digest of the base spans, and all spans."""
    found = find_secrets(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))).drop("text")
    spans, base = F.col("spans"), F.filter("spans", lambda s: s["kind"].isin(*BASE))
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    return found.select("doc_id", *[count(k).alias(f"n_{k}") for k in BASE],
                        F.sha2(span_text(base), 256).alias("base_sha256"), span_text(spans).alias("spans"))
