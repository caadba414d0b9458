"""Personal data by base patterns and a skip-chain conditional random field.

Base.  Leftmost non-overlapping matches per kind of the patterns below; matches
that fail their check (parts over 255, digit counts, Luhn) are dropped.

Method.  Words with an ``@``, with three digits, or that hold the local part of
an e-mail address of the document are the nodes of a random field over the
labels none, email, ip, card and phone; every other word is none.  Neighbouring
nodes share chain potentials.  Skip edges tie a word to the next mention,
however distant, that may be of the same entity, with a learned potential for
each kind of likeness (``TIES``): the same word, the same digits in another
notation, digits that end the other's digits, digits that agree in their first
six or last four places, and an address's local part.  A base span stands in
these chains by the digits of the whole span.  Chains of mentions, not all
pairs, keep the graph linear.  Loopy sum-product message passing (damped, fixed
rounds) enforces one label for an entity across the document.  Base spans are
observed; nodes whose posterior for a kind reaches ``ACCEPT`` become spans too,
neighbouring ones of a kind joined.

Learning.  Base spans alone would teach the field its own patterns.  So each
training document gets, for a part of its entities, a rewritten mention
elsewhere in the text (:func:`planted`: other separators, no prefix, last
digits, local part) with the entity's label, and as many decoys of the same
shapes over random digits and words, with the label none.  Unary, chain and tie
weights are then learned together by pseudo-likelihood; none is set by hand.
Training is on at most about ``MAX_TRAIN_DOCS`` documents of up to
``TRAIN_CHARS`` characters that have digits or an ``@``, drawn by a hash of the
text: documented bounds of the fit; every text is searched whole.

Edge cases.  Null text counts as empty: no spans.  Offsets are code points, ends
exclusive.  Rows are independent; repeated rows get equal results.  Spans that
start at one place are ordered by kind.  With no training document the field
adds nothing.  Input columns named like a result column are replaced.
"""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textcore as T
from .common import widened, without

KINDS = ("email", "ip", "card", "phone")
MAX_TRAIN_DOCS = 4000
TRAIN_CHARS = 16_384
VARIANTS = 3  # plantings of a training document
TIES = ("equal", "alike", "ending", "partial", "local")
ROUNDS, DAMPING = 12, 0.5
ACCEPT = 0.8
CHUNK_BYTES = 1 << 20
RESULT = ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added", "masked")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match cannot begin inside a run of digits whose first digit begins none.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
# Shorter runs fail the digit count, so only runs of 12 digits are looked for.
_CARD = re.compile(r"[0-9](?:[ -]?[0-9]){11,}")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGITS = re.compile(r"[^0-9]+")
_PIECE = re.compile(r"[A-Za-z0-9._%+-]+")
_ENDS = "._%+-"


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if k % 2:
            d = 2 * d - 9 * (d > 4)
        total += d
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            yield start, m.end()
        done = m.end() if m else at + 1  # a local part cannot hold the @
        at = text.find("@", done)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the base patterns, by start and kind."""
    found = [(a, b, 0) for a, b in _emails(text)]
    found += [(m.start(), m.end(), 1) for m in _IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = _DIGITS.sub("", m[0])
        if len(digits) <= 19 and luhn(digits):
            found.append((m.start(), m.end(), 2))
    for m in _PHONE.finditer(text) if "+" in text else ():
        if 9 <= len(_DIGITS.sub("", m[0])) <= 15:
            found.append((m.start(), m.end(), 3))
    return sorted(found, key=lambda s: (s[0], s[2]))


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def _features(word: str, digits: str, before: bool, after: bool, near: tuple[str, str]) -> list[float]:
    n = len(digits)
    marks = set(word)
    letters = any(c.isalpha() for c in word)
    found = [
        1.0, "@" in marks, "@" in marks and "." in word[word.find("@") :], n == 0, 0 < n < 4, 4 <= n < 7, 7 <= n < 9, 9 <= n < 12, 12 <= n < 16, n == 16, 16 < n < 20, n >= 20,
        "." in marks, word.count(".") == 3, "-" in marks, word[:1] == "+", "(" in marks or ")" in marks, letters, not letters and n > 0 and len(marks - set("0123456789-. ()+")) == 0,
        len(word) == n, 12 <= n < 20 and luhn(digits), before, after, before and after, len(word) > 24,
    ]
    for side, other in enumerate(near):
        place = [0.0] * CONTEXT
        if other:
            place[zlib.crc32(other.encode()) % CONTEXT] = 1.0
        found += place
    return found


CONTEXT = 16  # hashed places of the word before, and of the word after
N_FEATURES = 25 + 2 * CONTEXT
N_LABELS = len(KINDS) + 1
LEAST_LOCAL = 4  # characters of a local part that is looked for in other words


@dataclass
class Graph:
    x: np.ndarray
    doc: np.ndarray
    start: np.ndarray  # code points in the document
    end: np.ndarray
    label: np.ndarray  # of the base spans, 0 for none; in training -1 where it is unknown
    chain: np.ndarray  # m x 2 neighbouring nodes
    tie: np.ndarray  # m x 3: two nodes and the place of their likeness in TIES
    base: list[list[tuple[int, int, int]]]


_STRIP = ".,;:!?\"'()[]<>{}"


def _likeness(a: str, b: str) -> int | None:
    """The place in TIES of two digit strings."""
    if a == b:
        return 1 if len(a) >= 7 else None
    short, long = sorted((a, b), key=len)
    if len(short) >= 4 and len(long) >= 7 and long.endswith(short):
        return 2
    if len(short) >= 7 and (long[:6] == short[:6] or long[-4:] == short[-4:]):
        return 3
    return None


def ties(words: list[str], digits: list[str], locals_of: list[str | None]) -> list[tuple[int, int, int]]:
    """Edges of one document's nodes: each mention to the nearest earlier one under every key that they share, one edge a likeness.

    digits holds the digits of a node, of the whole span for the last node of a base span and none for its others; locals_of the local part that a node holds.
    """
    last: dict[tuple[str, str], int] = {}
    found: set[tuple[int, int, int]] = set()
    for i, word in enumerate(words):
        d = digits[i]
        keys = [("word", word.strip(_STRIP))]
        if len(d) >= 4:
            keys.append(("last", d[-4:]))
        if len(d) >= 7:
            keys += [("digits", d), ("first", d[:6])]
        if locals_of[i]:
            keys.append(("local", locals_of[i]))
        for key in keys:
            j = last.get(key)
            last[key] = i
            if j is None:
                continue
            if key[0] == "word":
                kind = 0
            elif key[0] == "local":
                kind = 4
            else:
                kind = _likeness(digits[j], d)
            if kind is not None:
                found.add((j, i, kind))
    return sorted(found)


def graph(texts: pa.Array, planted_spans: list[list[tuple[int, int, int]]] | None = None) -> Graph:
    """Nodes and edges of a run of documents; planted spans, in training, are labels beside the base spans."""
    w = T.words(texts)
    data = w.data
    lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    digit = np.concatenate([[0], np.cumsum((data >= 0x30) & (data <= 0x39))])
    sign = np.concatenate([[0], np.cumsum(data == 0x40)])
    is_node = (digit[w.end] - digit[w.start] >= 3) | (sign[w.end] > sign[w.start])
    first_char = lead[w.doc_byte]  # code points before each document
    word_from, word_to = lead[w.start], lead[w.end]
    some = (digit[w.doc_byte[1:]] > digit[w.doc_byte[:-1]]) | (sign[w.doc_byte[1:]] > sign[w.doc_byte[:-1]])
    base: list[list[tuple[int, int, int]]] = [[] for _ in range(w.n_docs)]
    held: dict[int, str] = {}  # word -> the local part that it holds
    lines: dict[int, str] = {}
    for d in np.flatnonzero(some).tolist():
        line = lines[d] = texts[d].as_py()
        base[d] = base_spans(line)
        locals_ = {line[a:b].split("@")[0].strip(_ENDS) for a, b, kind in base[d] if kind == 0}
        for m in _PIECE.finditer(line) if locals_ else ():
            piece = m[0].strip(_ENDS)
            if len(piece) >= LEAST_LOCAL and piece in locals_:
                word = int(np.searchsorted(word_from, m.start() + first_char[d], side="right")) - 1
                is_node[word] = True
                held[word] = piece
    node = np.flatnonzero(is_node)
    doc_of = w.doc_of()[node]
    start, end = word_from[node] - first_char[doc_of], word_to[node] - first_char[doc_of]
    label = np.zeros(len(node), dtype=np.int64)
    bounds = np.searchsorted(doc_of, np.arange(w.n_docs + 1))
    next_to = (node[1:] == node[:-1] + 1) & (doc_of[1:] == doc_of[:-1]) if len(node) > 1 else np.zeros(0, dtype=bool)
    before, after = np.r_[False, next_to][: len(node)], np.r_[next_to, False][: len(node)]
    text_of = lambda k: bytes(data[w.start[k] : w.end[k]]).decode()
    words = [text_of(k) for k in node.tolist()]
    digits = [_DIGITS.sub("", x) for x in words]
    near = lambda k, d: text_of(k).strip(_STRIP).lower() if w.doc_word[d] <= k < w.doc_word[d + 1] else ""
    features = [_features(x, g, before[i], after[i], (near(k - 1, d), near(k + 1, d))) for i, (x, g, k, d) in enumerate(zip(words, digits, node.tolist(), doc_of.tolist()))]
    edges = []
    for d in np.flatnonzero(np.diff(bounds)).tolist():
        a, b = int(bounds[d]), int(bounds[d + 1])
        starts, ends = start[a:b], end[a:b]
        spans = [(*s, True) for s in base[d]] + [(*s, False) for s in (planted_spans[d] if planted_spans else [])]
        for x, y, kind, is_base in reversed(spans):
            # nodes are words in order, so those that a span touches are a run
            first, last = a + int(np.searchsorted(ends, x, side="right")), a + int(np.searchsorted(starts, y, side="left"))
            label[first:last] = kind + 1
            if kind and is_base and first < last:
                digits[first:last] = [""] * (last - first)
                digits[last - 1] = _DIGITS.sub("", lines[d][x:y])  # the span's last node stands for it
        mine = [(i + a, j + a, kind) for i, j, kind in ties(words[a:b], digits[a:b], [held.get(k) for k in node[a:b].tolist()])]
        if planted_spans is not None:
            # a mention beside a span that the patterns miss may well be of the same entity: neither label is taught
            for i, j, kind in mine:
                if (label[i] > 0) != (label[j] > 0) and (kind == 4 or kind < 3 and min(len(digits[i]), len(digits[j])) >= 7):
                    label[i], label[j] = (x if x else -1 for x in (label[i], label[j]))
        edges += mine
    left = np.flatnonzero(next_to)
    return Graph(np.array(features, dtype=np.float64).reshape(-1, N_FEATURES), doc_of, start, end, label, np.column_stack([left, left + 1]), np.array(edges, dtype=np.int64).reshape(-1, 3), base)


@dataclass
class Field:
    unary: np.ndarray  # features x labels
    chain: np.ndarray  # labels x labels
    tie: np.ndarray  # log-potential of equal labels, for each of TIES

    def edges(self, g: Graph) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        tables = np.concatenate([self.chain[None], self.tie[:, None, None] * np.eye(N_LABELS)])
        kind = np.concatenate([np.zeros(len(g.chain), dtype=np.int64), g.tie[:, 2] + 1])
        pair = np.concatenate([g.chain, g.tie[:, :2]])
        return pair[:, 0], pair[:, 1], tables[kind]

    def posteriors(self, g: Graph, observed: bool = True, rounds: int = ROUNDS) -> np.ndarray:
        """Marginals after loopy message passing, base labels observed."""
        score = g.x @ self.unary
        if observed:
            known = g.label > 0
            score[known] = -50.0
            score[known, g.label[known]] = 0.0
        i, j, psi = self.edges(g)
        to_j, to_i = np.zeros((len(i), N_LABELS)), np.zeros((len(i), N_LABELS))

        def send(source: np.ndarray, table: np.ndarray, old: np.ndarray) -> np.ndarray:
            new = _log_sum(source[:, :, None] + table)
            return DAMPING * old + (1 - DAMPING) * (new - new.max(axis=1, keepdims=True))

        belief = score.copy()
        for _ in range(rounds if len(i) else 0):
            now_j = send(belief[i] - to_i, psi, to_j)
            now_i = send(belief[j] - to_j, psi.transpose(0, 2, 1), to_i)
            to_j, to_i = now_j, now_i
            belief = score.copy()
            np.add.at(belief, j, to_j)
            np.add.at(belief, i, to_i)
        p = np.exp(belief - belief.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)


def _log_sum(x: np.ndarray) -> np.ndarray:
    top = x.max(axis=1)
    return top + np.log(np.exp(x - top[:, None, :]).sum(axis=1))


def fit(graphs: list[tuple[np.ndarray, ...]], steps: int = 300, rate: float = 0.1, decay: float = 1e-5) -> Field | None:
    """Pseudo-likelihood by Adam; graphs: (x, label, chain, tie) of documents."""
    if not graphs:
        return None
    base = np.cumsum([0, *[len(g[0]) for g in graphs]])
    x, label = np.concatenate([g[0] for g in graphs]), np.concatenate([g[1] for g in graphs])
    chain = np.concatenate([g[2] + o for g, o in zip(graphs, base)])
    tie = np.concatenate([g[3] + np.array([o, o, 0]) for g, o in zip(graphs, base)])
    one = np.where(label[:, None] < 0, 0, np.eye(N_LABELS)[label])
    left, right = np.zeros_like(one), np.zeros_like(one)
    right[chain[:, 0]] = one[chain[:, 1]]
    left[chain[:, 1]] = one[chain[:, 0]]
    tied = np.zeros((len(TIES), *one.shape))  # labels at the other ends, by likeness
    np.add.at(tied, (tie[:, 2], tie[:, 0]), one[tie[:, 1]])
    np.add.at(tied, (tie[:, 2], tie[:, 1]), one[tie[:, 0]])
    parts = [np.zeros((N_FEATURES, N_LABELS)), np.zeros((N_LABELS, N_LABELS)), np.zeros(len(TIES))]
    mean, square = [np.zeros_like(v) for v in parts], [np.zeros_like(v) for v in parts]
    # nodes with ties are few beside plain numbers: both halves weigh the same
    some = tied.sum(axis=(0, 2)) > 0
    weight = np.where(some, 0.5 / max(1, some.sum()), 0.5 / max(1, (~some).sum()))[:, None] * (label >= 0)[:, None]
    for step in range(1, steps + 1):
        unary, table, same = parts
        score = x @ unary + left @ table + right @ table.T + np.tensordot(same, tied, axes=1)
        p = np.exp(score - score.max(axis=1, keepdims=True))
        gap = (one - p / p.sum(axis=1, keepdims=True)) * weight
        slopes = [x.T @ gap, left.T @ gap + gap.T @ right, (tied * gap).sum(axis=(1, 2))]
        for k, slope in enumerate(slopes):
            slope = slope - decay * parts[k]
            mean[k] = 0.9 * mean[k] + 0.1 * slope
            square[k] = 0.99 * square[k] + 0.01 * slope**2
            parts[k] = parts[k] + rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-9)
        parts[2] = np.maximum(parts[2], 0)  # likeness may speak for one label, not against it
    return Field(*parts)


def rewritten(entity: str, kind: int, rng: random.Random) -> str:
    """Another mention of an entity, which no base pattern finds."""
    digits = _DIGITS.sub("", entity)
    if kind == 0:
        local, domain = entity.split("@")[:2]
        return rng.choice([local, f"{local}(at){domain}", f"{local} at {domain}", f"<{local}>", f"{local}[at]{domain.replace('.', '[dot]')}"])
    if kind == 1:
        return rng.choice([entity.replace(".", "-"), entity.replace(".", "[.]"), entity.replace(".", "_"), ":".join(entity.split("."))])
    if kind == 2:
        groups = [digits[k : k + 4] for k in range(0, len(digits), 4)]
        slip = f"{digits[:7]}{(int(digits[7]) + rng.randint(1, 9)) % 10}{digits[8:]}"
        return rng.choice([".".join(groups), "_".join(groups), "/".join(groups), digits[-4:], "x" + digits[-4:], slip])
    area, middle, last = digits[-10:-7], digits[-7:-4], digits[-4:]
    slip = f"{area}{(int(middle[0]) + rng.randint(1, 9)) % 10}{middle[1:]}{last}"
    return rng.choice([f"{area}-{middle}-{last}", f"{middle}-{last}", f"{middle}.{last}", area + middle + last, middle + last, slip])


def decoy(entity: str, kind: int, rng: random.Random) -> str:
    """A string of the same shape that has nothing to do with the entity."""
    swap = lambda c: str(rng.randrange(10)) if c in "0123456789" else rng.choice("abcdefghijklmnopqrstuvwxyz") if c.isalpha() and kind == 0 else c
    return "".join(swap(c) for c in rewritten(entity, kind, rng))


def planted(text: str, rng: random.Random, share: float = 0.5) -> tuple[str, list[tuple[int, int, int]]]:
    """text with rewritten mentions of a share of its entities and as many decoys put between its words; the mentions' spans."""
    spans = base_spans(text)
    more = []
    for a, b, kind in spans:
        if rng.random() < share:
            more.append((rewritten(text[a:b], kind, rng), kind))
        if rng.random() < share:
            more.append((decoy(text[a:b], kind, rng), None))
    gaps = [m.end() for m in re.finditer(r"\s+", text)]
    gaps = [g for g in gaps if not any(a < g < b for a, b, _ in spans)]
    if not more or not gaps:
        return text, []
    out, at, size, found = [], 0, 0, []
    for gap, (mention, kind) in sorted(((rng.choice(gaps), m) for m in more), key=lambda x: x[0]):
        out.append(text[at:gap])
        size += gap - at
        at = gap
        if kind is not None:
            found.append((size, size + len(mention), kind))
        out.append(mention + " ")
        size += len(mention) + 1
    new = "".join([*out, text[at:]])
    # where a mention has become part of a base span, that span says all
    known = base_spans(new)
    return new, [s for s in found if not any(a < s[1] and b > s[0] for a, b, _ in known)]


_PARTS = "x binary, label binary, chain binary, tie binary"


def _samples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k, text in itertools.product(range(VARIANTS), T.strings(batch.column("text")).to_pylist()):
            new, spans = planted(text, random.Random(zlib.crc32(text.encode()) + k))
            g = graph(pa.array([new], pa.large_string()), [spans])
            if len(g.x):
                yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in (g.x, g.label, g.chain, g.tie)], names=["x", "label", "chain", "tie"])


def train(docs: DataFrame, max_docs: int = MAX_TRAIN_DOCS) -> Field | None:
    """Learn from about max_docs of the documents that hold digits or an @."""
    rows = docs.select("text").where(F.col("text").rlike("[0-9]{3}|@") & (F.length("text") <= TRAIN_CHARS))
    rate = min(1.0, max_docs / max(1, rows.count()))
    drawn = rows.where(F.pmod(F.xxhash64(F.lit("pii"), "text"), F.lit(1_000_000)) < int(rate * 1_000_000))
    parts = drawn.mapInArrow(_samples, _PARTS).collect()

    def read(p) -> tuple[np.ndarray, ...]:
        whole = lambda name, width: np.frombuffer(p[name], dtype=np.int64).reshape(-1, width)
        return np.frombuffer(p["x"]).reshape(-1, N_FEATURES), np.frombuffer(p["label"], dtype=np.int64), whole("chain", 2), whole("tie", 3)

    return fit([read(p) for p in sorted(parts, key=lambda p: (p["x"], p["label"]))])


_TRIM = re.compile(r"^[\"'\[<{,;:]*(.*?)[\"'\]>},;:.!?]*$", re.S)


def added_spans(g: Graph, field: Field | None, texts: pa.Array) -> list[list[tuple[int, int, int]]]:
    """Spans of the field that no base span touches."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in g.base]
    if field is None or not len(g.x):
        return out
    p = field.posteriors(g)
    best = p.argmax(axis=1)
    take = np.flatnonzero((best > 0) & (p.max(axis=1) >= ACCEPT) & (g.label == 0))
    linked = set(map(tuple, g.chain.tolist()))
    last, of, line = None, -1, ""
    for i in take.tolist():
        d, kind = int(g.doc[i]), int(best[i]) - 1
        if d != of:
            of, line = d, texts[d].as_py()
        text = line[int(g.start[i]) : int(g.end[i])]
        core = _TRIM.match(text)
        a, b = int(g.start[i]) + core.start(1), int(g.start[i]) + core.end(1)
        if a >= b:
            continue
        if last == (i - 1, d, kind) and (i - 1, i) in linked:
            a = out[d].pop()[0]
        out[d].append((a, b, kind))
        last = (i, d, kind)
    return out


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """text with every span replaced by its kind; overlapping spans become one."""
    at, out = 0, []
    for a, b, kind in spans:
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], f"[{KINDS[kind].upper()}]"]
        at = b
    return "".join([*out, text[at:]])


def _find(shared, fields: list[str], masks: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field: Field | None = shared.value
        for batch in batches:
            texts = T.strings(batch.column("text"))
            for a, b in T.slices(texts, CHUNK_BYTES):
                part = texts.slice(a, b - a)
                g = graph(part)
                more = added_spans(g, field, part)
                every = [sorted(x + y, key=lambda s: (s[0], s[2])) if y else x for x, y in zip(g.base, more)]
                columns = [batch.column(f).slice(a, b - a) for f in fields]
                columns += [pa.array([sum(s[2] == k for s in x) for x in g.base], pa.int64()) for k in range(len(KINDS))]
                columns += [pa.array([hashlib.sha256(joined(x).encode()).hexdigest() for x in g.base]), pa.array([joined(x) for x in every], pa.string()), pa.array([len(y) for y in more], pa.int64())]
                if masks:
                    original = batch.column("text").slice(a, b - a)
                    columns.append(pa.array([masked(t.as_py(), x) if x else t.as_py() for t, x in zip(original, every)], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=[*fields, *RESULT[: 8 if masks else 7]])

    return run


def find_pii(docs: DataFrame, field: Field | None, masks: bool = True) -> DataFrame:
    """docs with base counts, base_sha256, all spans, n_added and, if asked for, the masked text."""
    docs = without(docs, RESULT)
    shared = docs.sparkSession.sparkContext.broadcast(field)
    kinds = ["long"] * 4 + ["string", "string", "long", "string"]
    return docs.mapInArrow(_find(shared, docs.columns, masks), widened(docs, list(zip(RESULT, kinds))[: 8 if masks else 7]))


def op3_pii_crf(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return find_pii(docs, train(docs), masks=False).drop("text")
