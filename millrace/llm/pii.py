"""Personal data found by rules, and by a skip-chain conditional random field that adds the mentions rules miss.

Rules find e-mail addresses, IP addresses, card and phone numbers. Words and groups of numbers that hold a digit or an `@`, or that repeat an address's name,
are the field's variables; their labels are the four kinds or none. Mentions of the rules are observed. Neighbours share a chain potential; a token and the
next one in the document with the same (or a similar: equal name of an address, first eight or last seven digits) content share a skip potential, however far
apart. Loopy sum-product passes messages until they stand still, so a mention that rules know lends its label to its damaged repetitions.

There are no labels to learn from, so the field is fitted to damaged copies: into each document of a bounded sample, damaged copies of its own mentions are put,
labelled with their kind, and damaged copies of other documents' mentions, labelled none. Weights are those of the greatest penalised pseudo-likelihood.

Defined cases: null and empty texts hold nothing; texts are taken whole, however long, and work grows in proportion to their length. Repeated rows give
repeated results, null ids are kept, an empty table gives an empty result. Further columns are not read."""

from __future__ import annotations

import random
import re
from collections.abc import Iterator, Sequence
from hashlib import sha256
from typing import NamedTuple
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import small_batches, text_bytes
from millrace.llm.labelled import fit_once

#: Kinds in their order; the labels of the field are "none" (0) and the kinds from 1.
KINDS = ("email", "ip", "card", "phone")
LABELS = len(KINDS) + 1
#: Bounds of the sample that the field is fitted to: documents, and characters of each (longer ones are not drawn).
MAX_ROWS, MAX_CHARS = 2000, 20_000
#: Rounds of messages at most, and the change at which they stand still.
ROUNDS, STILL = 100, 1e-4
#: Least probability at which a token that rules do not know is taken for a mention.
SURE = 0.6

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# Runs of digits are taken whole, so long ones are looked at once; a match never starts inside one.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MARK = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"[+(]{0,2}[0-9]++(?:[\x20().-]{1,3}[0-9]++)*+(?![^\x20\x09-\x0D.,;:!?)\]}>'\"*#%&$|])|[^\x20\x09-\x0D]+")
_EDGES = ".,;:!?\"'()[]{}<>*#%&$|"
_AT = re.compile(r"@|[\[(]at[\])]", re.IGNORECASE)
_QUAD = re.compile(r"[0-9]{1,3}(?:[^0-9][0-9]{1,3}){3}")
_BEFORE = 64
N_FEATURES = 19 + _BEFORE
#: Skip edges by type: same content, similar content.
SAME, SIMILAR = 0, 1

Span = tuple[int, int, int]  # start, kind's place in KINDS, end


def luhn(digits: str) -> bool:
    return sum(sum(divmod(2 * int(d), 10)) if k % 2 else int(d) for k, d in enumerate(reversed(digits))) % 10 == 0


def by_rules(text: str) -> list[Span]:
    """Mentions that rules find, by start and kind. Each kind is matched from left to right by itself; matches that fail its test are passed over."""
    found: list[Span] = []
    at, done = text.find("@"), 0
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, 0, domain.end()))
            done = domain.end()
        else:
            done = at + 1
        at = text.find("@", at + 1)
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part) <= 255 for part in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


class Tokens(NamedTuple):
    """The variables of a document: spans, number among all its tokens, features, and the label that rules give (0 where none do)."""

    spans: list[tuple[int, int]]
    places: list[int]
    features: list[list[int]]
    known: list[int]
    skips: list[tuple[int, int, int]]  # earlier, later, type


def _keys(core: str) -> list[tuple[str, str, int]]:
    """Under which names a token meets its repetitions, and the type of edge that each makes."""
    low = core.lower()
    parts = _AT.split(low, maxsplit=1)
    if len(parts) == 2:
        return [("w", low, SAME), ("l", parts[0], SIMILAR)] if len(parts[0]) > 3 else [("w", low, SAME)]
    digits = "".join(c for c in core if "0" <= c <= "9")
    if any(c.isalpha() for c in core):
        return [("w", low, SAME), ("l", low, SIMILAR)] if len(low) > 3 else [("w", low, SAME)]
    keys = [("d", digits, SAME)] if len(digits) > 3 else []
    if len(digits) > 7:
        keys.append(("h", digits[:8], SIMILAR))
    if len(digits) > 6:
        keys.append(("t", digits[-7:], SIMILAR))
    return keys


def _features(core: str, before: str) -> list[int]:
    digits = sum("0" <= c <= "9" for c in core)
    on = [0, 1 + sum(digits > b for b in (0, 2, 4, 7, 11, 19)), 8 + min(core.count("."), 4)]
    tests = ("@" in core, any(c.isalpha() for c in core), "-" in core, " " in core, core[:1] in "+(", bool(_QUAD.fullmatch(core)))
    return on + [13 + k for k, hit in enumerate(tests) if hit] + [19 + crc32(before.lower().encode()) % _BEFORE]


def tokens(text: str, rules: Sequence[Span]) -> Tokens:
    out = Tokens([], [], [], [], [])
    names = {text[s:e].lower().partition("@")[0] for s, kind, e in rules if kind == 0}
    last: dict[tuple[str, str], int] = {}
    before, rule, reach = "", 0, 0
    for place, m in enumerate(_TOKEN.finditer(text)):
        word = m.group()
        # A closing bracket belongs to a token that opens it.
        core = word if word[:1] in "+(" and word[-1:].isdigit() else word.strip(_EDGES)
        if core and (_MARK.search(core) or core.lower() in names):
            start = m.start() + word.index(core)
            end = start + len(core)
            while rule < len(rules) and rules[rule][2] <= start:
                rule += 1
            k = rule
            while k < len(rules) and rules[k][0] < end and rules[k][2] <= start:
                k += 1
            hit = k < len(rules) and rules[k][0] < end
            n = len(out.spans)
            out.spans.append((start, end))
            out.places.append(place)
            out.features.append(_features(core, before))
            out.known.append(rules[k][1] + 1 if hit else 0)
            met = set()
            for name, value, kind in _keys(core):
                other = last.get((name, value))
                if other is not None and other not in met:
                    met.add(other)
                    out.skips.append((other, n, kind))
                last[name, value] = n
        before = word
    return out


class Field(NamedTuple):
    """Weights: features by label, chain (left label by right label), and skip edges by type (symmetric)."""

    unary: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


def chains(places: Sequence[int]) -> list[tuple[int, int]]:
    """Variables that stand side by side in the text."""
    return [(k, k + 1) for k in range(len(places) - 1) if places[k] + 1 == places[k + 1]]


def evidence(field: Field, t: Tokens) -> np.ndarray:
    """What features, known labels and neighbours that are no variables (label none) say of each variable."""
    total = np.stack([field.unary[on].sum(axis=0) for on in t.features]) if t.features else np.zeros((0, LABELS))
    pairs = chains(t.places)
    left, right = np.ones(len(total), bool), np.ones(len(total), bool)
    for a, b in pairs:
        right[a] = left[b] = False
    total += left[:, None] * field.chain[0] + right[:, None] * field.chain[:, 0]
    for k, label in enumerate(t.known):
        if label:
            total[k] = -1e3
            total[k, label] = 0
    return total


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def beliefs(unary: np.ndarray, edges: np.ndarray, potentials: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Probabilities of the labels of each variable by loopy sum-product; exact where edges make no loops.

    `unary` is (variables, labels); `edges` holds pairs of variables, `potentials` the log potential (first label, second label) of each."""
    n, labels = unary.shape
    total = unary
    if len(edges):
        a, b = edges[:, 0], edges[:, 1]
        # Messages a to b, then b to a.
        source, target = np.concatenate([a, b]), np.concatenate([b, a])
        table = np.concatenate([potentials, potentials.transpose(0, 2, 1)])
        messages = np.zeros((len(source), labels))
        back = np.concatenate([np.arange(len(a)) + len(a), np.arange(len(a))])
        for _ in range(rounds):
            into = np.stack([np.bincount(target, messages[:, k], n) for k in range(labels)], axis=1)
            total = unary + into
            fresh = _logsum((total[source] - messages[back])[:, :, None] + table, 1)
            fresh -= fresh.max(axis=1, keepdims=True)
            change = np.abs(fresh - messages).max()
            # Half a step, so that messages around short loops do not swing.
            messages = (messages + fresh) / 2
            if change < STILL:
                break
        total = unary + np.stack([np.bincount(target, messages[:, k], n) for k in range(labels)], axis=1)
    return np.exp(total - _logsum(total, 1)[:, None])


def label_probabilities(field: Field, many: Sequence[Tokens]) -> list[np.ndarray]:
    """Beliefs of the variables of several documents, worked out together."""
    starts = np.cumsum([0, *(len(t.spans) for t in many)])
    unary = np.concatenate([evidence(field, t) for t in many] or [np.zeros((0, LABELS))])
    pairs = [(base + a, base + b, -1) for base, t in zip(starts, many) for a, b in chains(t.places)] + [(base + a, base + b, kind) for base, t in zip(starts, many) for a, b, kind in t.skips]
    edges = np.array(pairs, np.int64).reshape(-1, 3)
    tables = np.concatenate([field.skip, field.chain[None]])[edges[:, 2]]
    found = beliefs(unary, edges[:, :2], tables)
    return [found[starts[k] : starts[k + 1]] for k in range(len(many))]


def added(t: Tokens, probability: np.ndarray) -> list[Span]:
    """Mentions among the variables that rules do not know; neighbours of one kind are one mention."""
    spans: list[Span] = []
    previous = None
    for k, (start, end) in enumerate(t.spans):
        label = int(probability[k].argmax())
        if t.known[k] or not label or probability[k, label] < SURE:
            previous = None
            continue
        if previous == (t.places[k] - 1, label):
            spans[-1] = (spans[-1][0], label - 1, end)
        else:
            spans.append((start, label - 1, end))
        previous = (t.places[k], label)
    return spans


# --- fitting


def _damaged(text: str, kind: int, rng: random.Random) -> str:
    """A mention as it might be repeated so that rules do not know it."""
    if kind == 0:
        local, _, domain = text.partition("@")
        return rng.choice([local, f"{local}(at){domain}", f"{local}[at]{domain}", f"{local}@{domain.split('.')[0]}"])
    if kind == 1:
        return rng.choice([text.replace(".", sep) for sep in (" ", "-", ". ")])
    if kind == 2:
        digits = re.sub("[^0-9]", "", text)
        k = rng.randrange(9, len(digits))
        return rng.choice([digits[:k] + str((int(digits[k]) + rng.randrange(1, 10)) % 10) + digits[k + 1 :], digits[:-2], ".".join(digits[j : j + 4] for j in range(0, len(digits), 4))])
    digits = re.sub("[^0-9]", "", text)
    national = digits[-10:]
    return rng.choice([text[1:], text[1:].partition(" ")[2] or text[1:], national, f"{national[:3]}.{national[3:6]}.{national[6:]}"])


def _with_copies(text: str, rules: list[Span], others: list[tuple[str, int]], rng: random.Random) -> tuple[str, list[tuple[int, int, int]]]:
    """The text with damaged copies put at word gaps: its own mentions' (labelled) and others' (label none); and where they stand."""
    gaps = [m.start() for m in re.finditer("[\x20\x09-\x0d]", text) if not any(s < m.start() < e for s, _, e in rules)] or [len(text)]
    puts = [(rng.choice(gaps), _damaged(text[s:e], kind, rng), kind + 1) for s, kind, e in rules[:20]]
    puts += [(rng.choice(gaps), _damaged(*other, rng), 0) for other in rng.sample(others, min(len(others), 2))]
    out, marks, done = [], [], 0
    length = 0
    for gap, piece, label in sorted(puts):
        # A plain word before and after keeps neighbouring mentions apart.
        out += [text[done:gap], " so ", piece, " so"]
        length += gap - done + 4
        marks.append((length, length + len(piece), label))
        length += len(piece) + 3
        done = gap
    return "".join([*out, text[done:]]), marks


def fit(texts: list[bytes], _: list[int], steps: int = 400, penalty: float = 1e-4) -> Field:
    """Weights by gradient steps on the penalised pseudo-likelihood of the variables that rules do not know: each given its neighbours' labels."""
    decoded = [t.decode("utf-8", "replace") for t in texts]
    found = [by_rules(t) for t in decoded]
    mentions = [(t[s:e], kind) for t, spans in zip(decoded, found) for s, kind, e in spans[:20]]
    rows, left, right, beside, wanted = [], [], [], [], []
    for text, spans in zip(decoded, found):
        rng = random.Random(crc32(text.encode()))
        text, marks = _with_copies(text, spans, rng.sample(mentions, min(len(mentions), 3)), rng)
        t = tokens(text, by_rules(text))
        labels = [known or next((label for s, e, label in marks if s < end and start < e), 0) for known, (start, end) in zip(t.known, t.spans)]
        near = [np.zeros((2, LABELS)) for _ in labels]
        for a, b, kind in t.skips:
            near[a][kind, labels[b]] += 1
            near[b][kind, labels[a]] += 1
        before, after = [0] * len(labels), [0] * len(labels)
        for a, b in chains(t.places):
            after[a], before[b] = labels[b], labels[a]
        for k, known in enumerate(t.known):
            if not known:
                rows.append(t.features[k])
                left.append(before[k])
                right.append(after[k])
                beside.append(near[k])
                wanted.append(labels[k])
    field = Field(np.zeros((N_FEATURES, LABELS)), np.zeros((LABELS, LABELS)), np.zeros((2, LABELS, LABELS)))
    field.unary[0, 0] = 1.0
    if not rows:
        return field
    x, y = np.zeros((len(rows), N_FEATURES)), np.eye(LABELS)[wanted]
    for k, on in enumerate(rows):
        x[k, on] = 1
    near, lefts, rights = np.stack(beside), np.array(left), np.array(right)
    one_left, one_right = np.eye(LABELS)[lefts], np.eye(LABELS)[rights]
    mean, square = [np.zeros_like(w) for w in field], [np.zeros_like(w) for w in field]
    for step in range(1, steps + 1):
        score = x @ field.unary + field.chain[lefts] + field.chain[:, rights].T + np.einsum("ntl,tlm->nm", near, field.skip)
        error = (np.exp(score - _logsum(score, 1)[:, None]) - y) / len(rows)
        skip = np.einsum("ntl,nm->tlm", near, error)
        slopes = [x.T @ error, one_left.T @ error + error.T @ one_right, (skip + skip.transpose(0, 2, 1)) / 2]
        for w, g, m, v in zip(field, slopes, mean, square):
            g = g + penalty * w
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return field


# --- tables


def sample(docs: DataFrame, max_rows: int = MAX_ROWS, max_chars: int = MAX_CHARS) -> DataFrame:
    """(id, y, text) of at most `max_rows` different documents with a digit or an `@` and at most `max_chars` characters, the first by a hash of id and text."""
    fit_for = docs.filter((F.length("text") <= max_chars) & F.col("text").rlike("[0-9@]")).select(F.xxhash64("doc_id", "text").alias("id"), text_bytes().alias("text"))
    chosen = fit_for.select("id").distinct().orderBy("id").limit(max_rows)
    return fit_for.join(F.broadcast(chosen), "id").groupBy("id").agg(F.lit(0).alias("y"), F.min("text").alias("text"))


def train(docs: DataFrame, max_rows: int = MAX_ROWS, max_chars: int = MAX_CHARS) -> Field:
    return fit_once(sample(docs, max_rows, max_chars), fit)


def named(spans: Sequence[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def describe(texts: Sequence[str], field: Field) -> Iterator[tuple]:
    """Numbers of mentions by rules of each kind, digest of these mentions, all mentions and the number of added ones, for each text."""
    rules = [by_rules(t) if _MARK.search(t) else [] for t in texts]
    # Without a mention that rules know, nothing observed can lend a label; features alone still may give one.
    marked = [k for k, t in enumerate(texts) if _MARK.search(t)]
    many = [tokens(texts[k], rules[k]) for k in marked]
    extra = {k: added(t, p) for k, t, p in zip(marked, many, label_probabilities(field, many))}
    for k, spans in enumerate(rules):
        more = extra.get(k, [])
        yield *(sum(kind == n for _, kind, _ in spans) for n in range(len(KINDS))), sha256(named(spans).encode()).hexdigest(), named([*spans, *more]), len(more)


def find(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (found by rules), base_sha256, spans (all, as kind:start:end) and n_added for each row."""
    small_batches(docs.sparkSession)
    if field is None:
        field = train(docs)
    names = [*(f"n_{kind}" for kind in KINDS), "base_sha256", "spans", "n_added"]
    types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
    columns = ", ".join(f"{n} {'string' if t == pa.string() else 'long'}" for n, t in zip(names, types))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(describe([t.decode("utf-8", "replace") for t in batch.column("text").to_pylist()], field))
            values = list(zip(*rows)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(values, types))], ["doc_id", *names])

    return docs.select("doc_id", text_bytes().alias("text")).mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {columns}")
