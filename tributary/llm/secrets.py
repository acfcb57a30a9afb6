"""Secret scans: all rules in one pass over the bytes of a text, by a combined deterministic automaton."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .automaton import Tables, anchored, scanner
from .common import by_arrow, text_bytes


class Rule(NamedTuple):
    """Matches of ``pattern`` whose ``group`` (0: all of it) has at least ``least`` characters."""

    kind: str
    pattern: str
    least: int
    group: int = 0


# The base rules, then the public formats of a few providers.
BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 6, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]{24,}", 24),
)
PROVIDERS = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 20),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 39),
    Rule("pem", r"-----BEGIN (RSA |EC |DSA |OPENSSH |ENCRYPTED )?PRIVATE KEY-----", 1),
)
RULES = BASE + PROVIDERS


class Scan:
    """The compiled rules. A match is at least 24 bytes for ``hex``, whose runs shorter than that are no matches anyway."""

    def __init__(self, rules: tuple[Rule, ...], tables: Tables, backward: list[Tables]):
        self.rules = rules
        self.column = tables.column.tobytes()
        to = tables.to.tolist()
        # A state is its row of next rows: following it is one lookup a byte. The last entry holds the matched rules.
        rows: list[list] = [[] for _ in to]
        for row, targets, matched in zip(rows, to, tables.matched.tolist()):
            row.extend(rows[t] for t in targets)
            row.append(matched)
        self.start = rows[0]
        self.back = [(t.column.tolist(), t.to.tolist(), t.matched.tolist()) for t in backward]
        self.exact = [re.compile(r.pattern.encode()) for r in rules]

    def spans(self, raw: bytes) -> list[tuple[int, int, int]]:
        """``(start, rule, end)`` in bytes, by start, then rule."""
        found, ended, state, before, at = [], [0] * len(self.rules), self.start, 0, 0
        for c in raw.translate(self.column):
            state = state[c]
            if state[-1] != before:
                self.close(raw, before & ~state[-1], at, ended, found)
                before = state[-1]
            at += 1
        self.close(raw, before, at, ended, found)
        return sorted(found)

    def close(self, raw: bytes, rules: int, end: int, ended: list[int], found: list[tuple[int, int, int]]) -> None:
        while rules:
            k = (rules & -rules).bit_length() - 1
            rules &= rules - 1
            start = self.begin(raw, k, end, ended[k])
            ended[k] = end
            rule = self.rules[k]
            whole = self.exact[k].fullmatch(raw, start, end)
            if whole and len(whole.group(rule.group)) >= rule.least:
                found.append((start, k, end))

    def begin(self, raw: bytes, k: int, end: int, least: int) -> int:
        """The leftmost start of a match of rule ``k`` that ends at ``end``."""
        column, to, matched = self.back[k]
        state, start = 0, end
        for at in range(end - 1, least - 1, -1):
            state = to[state][column[raw[at]]]
            if matched[state]:
                start = at
            elif all(t == state for t in to[state]):
                break
        return start


def compile_rules(rules: tuple[Rule, ...] = RULES) -> tuple:
    """Arrays of the combined automaton and of each reversed rule, ready to send to executors."""
    return [tuple(r) for r in rules], tuple(scanner([r.pattern for r in rules])), [tuple(anchored(r.pattern, reverse=True)) for r in rules]


def compiled(held: dict) -> Scan:
    """The scan of a broadcast, built once in each Python worker."""
    if "scan" not in held:
        rules, tables, backward = held["rules"]
        held["scan"] = Scan(tuple(Rule(*r) for r in rules), Tables(*tables), [Tables(*t) for t in backward])
    return held["scan"]


def code_points(raw: bytes, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans counted in code points."""
    if raw.isascii():
        return spans
    follows = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) == 0x80).tolist()
    place = lambda at: at - bisect_left(follows, at)
    return [(place(a), k, place(b)) for a, k, b in spans]


def joined(rules, spans) -> str:
    return ",".join(f"{rules[k].kind}:{a}:{b}" for a, k, b in spans)


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans)``, a row for each row of ``docs``.

    ``spans`` lists ``kind:start:end`` in code points, the end exclusive, by start, then in the order of the rules. A null
    text is empty and has no spans. Rows are scanned one by one; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast({"rules": compile_rules(rules)})
    n_base = len(BASE)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        scan = compiled(shared.value)
        data, offsets = text_bytes(batch["text"])
        counts, digests, lists = [[] for _ in range(n_base)], [], []
        for a, b in zip(offsets, offsets[1:]):
            raw = bytes(data[a:b])
            found = scan.spans(raw)
            found = code_points(raw, found) if found else found
            own = [s for s in found if s[1] < n_base]
            for k in range(n_base):
                counts[k].append(sum(s[1] == k for s in own))
            digests.append(hashlib.sha256(joined(scan.rules, own).encode()).hexdigest())
            lists.append(joined(scan.rules, found))
        columns = [pa.array(c, pa.int64()) for c in counts]
        return pa.RecordBatch.from_arrays([batch["doc_id"], *columns, pa.array(digests), pa.array(lists)], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    zero, none = F.lit(0).cast("long"), F.lit("")
    schema = docs.select("doc_id", zero.alias("n_assign"), zero.alias("n_access"), zero.alias("n_hex"), none.alias("base_sha256"), none.alias("spans")).schema
    return by_arrow(docs.select("doc_id", "text"), schema, work)


def mask_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mask: str = "*") -> DataFrame:
    """``docs`` with every secret in ``text`` overwritten, one ``mask`` for each character; other columns unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast({"rules": compile_rules(rules)})
    columns = docs.columns

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        scan = compiled(shared.value)
        texts = batch["text"].to_pylist()
        for i, text in enumerate(texts):
            raw = (text or "").encode()
            if spans := scan.spans(raw):
                chars = list(text)
                for a, _, b in code_points(raw, spans):
                    chars[a:b] = mask * (b - a)
                texts[i] = "".join(chars)
        return batch.set_column(columns.index("text"), "text", pa.array(texts, batch["text"].type))

    return by_arrow(docs, docs.schema, work)
