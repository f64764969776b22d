"""Personal data (operator 3): base patterns, then a skip-chain conditional random field.

The field's nodes are the tokens with a digit or an at sign; neighbours in the text share a chain potential, repeated or
similar tokens, however far apart, a skip potential. Nodes inside base spans are observed. Loopy belief propagation over
the document's graph makes labels agree, so a number that was recognised once is also found where it lacks its plus sign or its
separators. A node's label becomes a further span if its belief exceeds `BELIEF`. Two tokens of one form are linked with each
other; more of them each with a hidden node of their form, so a group of m costs m links and a label is two steps from any
of its repeats.

Trained piecewise in numpy on texts that a seeded generator makes (names of cues, formats, plain numbers, secrets, prices, dates);
no row of the input is used, so scores don't depend on it.

Defined cases: null text counts as empty and has no spans; repeated rows each get a row; a null id stays; further columns are
ignored by `find_pii` and kept by `redact`.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, id_and_text, text_slices

KINDS = ("email", "ip", "card", "phone")
BELIEF = 0.9

_AT_LEFT = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a match never starts inside a run of digits: what fails at the run's start fails for the same reason further right
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGIT = re.compile("[0-9]")
_TOKEN = re.compile(WORD)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if i % 2:
            n = 2 * n - 9 * (n > 4)
        total += n
    return total % 10 == 0


def _emails(text: str):
    """The leftmost, non-overlapping matches, found from each at sign: linear where the plain pattern is quadratic in a run."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            end = m.end()
            yield start, end
            at = text.find("@", end)
        else:
            at = text.find("@", at + 1)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end), sorted."""
    out = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    if _DIGIT.search(text):
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text) if all(len(x := p.lstrip("0")) <= 3 and int(x or "0") <= 255 for p in m[0].split("."))]
        out += [(m.start(), 2, m.end()) for m in _CARD.finditer(text) if 12 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(d)]
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out)


# ---- the field ----
LABELS = ("none", *KINDS)
#: Words that announce a kind.
CUES = {
    "email": ("email", "mail", "e-mail", "contact", "write", "courriel", "correo"),
    "ip": ("ip", "host", "server", "address", "from", "client"),
    "card": ("card", "visa", "mastercard", "credit", "pay", "carte", "karte", "tarjeta"),
    "phone": ("phone", "tel", "call", "mobile", "fax", "telefon", "cell", "whatsapp"),
    "secret": ("password", "token", "key", "secret", "="),
}
_CUE_OF = {w: k for k, ws in CUES.items() for w in ws}


def _ends_in_domain(core: str) -> bool:
    """Whether letters follow the last dot, and that stands behind an at sign and something more; in one pass."""
    at, dot = core.find("@"), core.rfind(".")
    last = core[dot + 1 :]
    return 0 <= at < dot - 1 and len(last) >= 2 and last.isascii() and last.isalpha()


def _features(token: str, before: str, before2: str, after: str) -> list[str]:
    core = token.strip(".,;:!?\"'<>[]")
    digits = sum(c.isdigit() for c in core)
    letters = sum(c.isalpha() for c in core)
    out = ["bias", f"digits{min(digits, 20) if digits < 4 or 12 <= digits <= 20 else 5 if digits < 7 else 8 if digits < 10 else 10}"]
    out += ["letters"] * bool(letters) + ["at"] * ("@" in core) + ["plus"] * core.startswith("+") + ["equals"] * ("=" in core) + ["quoted"] * token.startswith('"')
    out += ["bracket"] * bool(re.fullmatch(r"\([0-9]{2,4}\)", core)) + ["quad"] * bool(re.fullmatch(r"[0-9]{1,3}(\.[0-9]{1,3}){3}", core)) + ["local7"] * bool(re.fullmatch(r"[0-9]{3}[-.][0-9]{4}", core))
    out += ["local10"] * bool(re.fullmatch(r"\(?[0-9]{3}\)?[-. ]?[0-9]{3}[-.][0-9]{4}", core)) + ["money"] * bool(re.match(r"[$€£%]|.*[$€£%]$", core)) + ["date"] * bool(re.fullmatch(r"[0-9]{1,4}[-/][0-9]{1,2}[-/][0-9]{1,4}", core))
    plain = core.replace("-", "")
    out += ["luhn"] * (plain.isascii() and plain.isdigit() and 12 <= len(plain) <= 19 and luhn(plain)) + ["domain"] * _ends_in_domain(core)
    for name, word in (("before", before), ("before2", before2), ("after", after)):
        word = word.lower().strip(".,;:!?\"'()")
        if word in _CUE_OF:
            out.append(f"{name}:{_CUE_OF[word]}")
        out += [f"{name}plus"] * (word.startswith("+")) + [f"{name}bracket"] * bool(re.fullmatch(r"[0-9]{3}", word) and name != "before2")
    return out


def _form(token: str) -> str:
    """What repeated or similar tokens share: the digits of numbers of six and more, the lower-cased text of others."""
    core = token.strip(".,;:!?\"'<>[]()").lower()
    digits = "".join(c for c in core if c.isdigit())
    return digits[-10:] if len(digits) >= 6 and not any(c.isalpha() for c in core) else core


class Field:
    def __init__(self, names: list[str]):
        self.index = {n: i for i, n in enumerate(names)}
        self.weights = np.zeros((len(names), len(LABELS)))
        self.chain = np.zeros((len(LABELS), len(LABELS)))
        self.skip = np.zeros((len(LABELS), len(LABELS)))

    def unary(self, features: Iterable[list[str]], n: int) -> np.ndarray:
        """The node factors of n nodes; features are taken one node at a time."""
        out = np.zeros((n, len(LABELS)))
        for i, f in enumerate(features):
            at = [self.index[x] for x in f if x in self.index]
            out[i] = self.weights[at].sum(axis=0)
        return out - out.max(axis=1, keepdims=True)

    def beliefs(self, unary: np.ndarray, edges: np.ndarray, kinds: np.ndarray, rounds: int = 12, damp: float = 0.3) -> np.ndarray:
        """Sum-product belief propagation; edges: (E, 2) node pairs, kinds: 0 chain, 1 skip. Exact where the graph is a tree that
        the rounds can cross."""
        if not len(edges):
            b = np.exp(unary)
            return b / b.sum(axis=1, keepdims=True)
        source = np.concatenate((edges[:, 0], edges[:, 1]))
        target = np.concatenate((edges[:, 1], edges[:, 0]))
        n = len(edges)
        table = np.exp(np.stack((self.chain, self.skip)))[kinds]
        table = np.concatenate((table, table.transpose(0, 2, 1)))
        back = np.concatenate((np.arange(n, 2 * n), np.arange(n)))
        message = np.zeros((2 * n, len(LABELS)))
        for _ in range(rounds):
            total = unary.copy()
            np.add.at(total, target, message)
            out = total[source] - message[back]
            out = np.exp(out - out.max(axis=1, keepdims=True))
            new = np.log(np.einsum("es,est->et", out, table) + 1e-300)
            new -= new.max(axis=1, keepdims=True)
            change = np.abs(new - message).max()
            message = (1 - damp) * new + damp * message
            if change < 1e-4:
                break
        total = unary.copy()
        np.add.at(total, target, message)
        b = np.exp(total - total.max(axis=1, keepdims=True))
        return b / b.sum(axis=1, keepdims=True)


class _Graph:
    """Nodes and edges of one text: `at` has the tokens that are nodes, `hubs` hidden nodes follow them."""

    def __init__(self, text: str):
        tokens = [m.span() for m in _TOKEN.finditer(text)]
        self.words = [text[a:b] for a, b in tokens]
        self.at = [i for i, w in enumerate(self.words) if "@" in w or _DIGIT.search(w)]
        self.spans = [tokens[i] for i in self.at]
        edges = [(k - 1, k, 0) for k in range(1, len(self.at)) if self.at[k - 1] == self.at[k] - 1]
        same: dict[str, list[int]] = {}
        for k, i in enumerate(self.at):
            same.setdefault(_form(self.words[i]), []).append(k)
        self.hubs = 0
        for ks in same.values():
            if len(ks) == 2:
                edges.append((*ks, 1))
            elif len(ks) > 2:
                edges += [(k, len(self.at) + self.hubs, 1) for k in ks]
                self.hubs += 1
        table = np.array(edges, dtype=np.int64).reshape(-1, 3)
        self.edges, self.kinds = table[:, :2], table[:, 2]
        self.alike = [ks for ks in same.values() if len(ks) > 1]

    def features(self) -> Iterator[list[str]]:
        get = lambda i: self.words[i] if 0 <= i < len(self.words) else ""
        for i in self.at:
            yield _features(self.words[i], get(i - 1), get(i - 2), get(i + 1))


def _training_texts(n: int, seed: int = 3):
    """(text, {(start, end): kind}) of invented sentences: each kind in its base format and in looser ones, and numbers of no kind."""
    rng = np.random.default_rng(seed)
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    number = lambda k: "".join(str(d) for d in rng.integers(0, 10, k))
    word = lambda: "".join(pick("abcdefghilmnoprstuv") for _ in range(int(rng.integers(2, 8))))

    def card() -> str:
        d = pick("3456") + number(14)
        return next(d + str(k) for k in range(10) if luhn(d + str(k)))

    def item():
        kind = int(rng.integers(0, 12))
        a, b, c = number(3), number(3), number(4)
        if kind == 0:
            return f"{word()}.{number(2)}@{word()}.{pick(['com', 'org', 'net'])}", 1
        if kind == 1:
            return ".".join(str(x) for x in rng.integers(1, 255, 4)), 2
        if kind == 2:
            d = card()
            return pick([d, f"{d[:4]}-{d[4:8]}-{d[8:12]}-{d[12:]}"]), 3
        if kind == 3:
            return pick([f"+1 ({a}) {b}-{c}", f"+1{a}{b}{c}", f"({a}) {b}-{c}", f"{a}-{b}-{c}"]), 4
        if kind in (4, 5):
            return pick([f"password={number(4)}{word()}{number(6)}", f'token = "{number(6)}{word()}{number(9)}"']), 0
        return pick([str(rng.integers(1900, 2100)), number(int(rng.integers(1, 8))), f"${number(3)}", f"{number(2)}%", f"{number(4)}-{number(2)}-{number(2)}", f"{number(1)}.{number(1)}.{number(1)}", number(int(rng.integers(10, 22))), f"{word()}{number(3)}", f"v{number(1)}.{number(2)}"]), 0

    for _ in range(n):
        parts, spans, at, seen = [], {}, 0, []
        for _ in range(int(rng.integers(2, 7))):
            for w in [word() for _ in range(int(rng.integers(1, 6)))]:
                parts.append(w)
                at += len(w) + 1
            what, kind = pick(seen) if seen and rng.random() < 0.3 else item()
            seen.append((what, kind))
            if kind and rng.random() < 0.4:
                cue = pick(CUES[KINDS[kind - 1]])
                parts.append(cue)
                at += len(cue) + 1
            if kind:
                spans[at, at + len(what)] = kind
            parts.append(what)
            at += len(what) + 1
        yield " ".join(parts), spans


@lru_cache(maxsize=1)
def trained(texts: int = 1500) -> Field:
    """Piecewise training: the node factor by softmax regression, chain and skip factors from how often labels meet."""
    rows, labels = [], []
    chain, skip = np.ones((5, 5)), np.ones((5, 5))
    for text, spans in _training_texts(texts):
        g = _Graph(text)
        y = [next((k for (a, b), k in spans.items() if a <= s < b), 0) for s, _ in g.spans]
        rows += g.features()
        labels += y
        met = [(chain, i, j) for (i, j), kind in zip(g.edges.tolist(), g.kinds.tolist(), strict=True) if not kind]
        met += [(skip, i, j) for ks in g.alike for i, j in zip(ks, ks[1:], strict=False)]
        for table, i, j in met:
            table[y[i], y[j]] += 1
            table[y[j], y[i]] += 1
    names = sorted({f for r in rows for f in r})
    field = Field(names)
    x = np.zeros((len(rows), len(names)))
    for i, r in enumerate(rows):
        x[i, [field.index[f] for f in r]] = 1
    y = np.array(labels)
    target = np.eye(5)[y]
    w, rate = field.weights, np.full((len(names), 5), 1e-6)
    for _ in range(300):
        z = x @ w
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        g = x.T @ (p - target) / len(y) + 1e-4 * w
        rate += g * g
        w -= 0.5 * g / np.sqrt(rate)
    for name, counts in (("chain", chain), ("skip", skip)):
        joint = counts / counts.sum()
        edge = np.log(joint / np.outer(joint.sum(axis=1), joint.sum(axis=0)))
        setattr(field, name, np.clip(edge, -4, 4))
    return field


def further_spans(text: str, base: list[tuple[int, int, int]], field: Field) -> list[tuple[int, int, int]]:
    """What the field adds to base, outside of its spans."""
    if "@" not in text and not _DIGIT.search(text):
        return []
    g = _Graph(text)
    if not g.at:
        return []
    unary = field.unary(g.features(), len(g.at))
    taken = np.zeros(len(g.at), bool)
    begins = np.array([s for s, _ in g.spans])
    stops = np.array([e for _, e in g.spans])
    for a, kind, b in base:
        lo, hi = np.searchsorted(stops, a, side="right"), np.searchsorted(begins, b, side="left")
        unary[lo:hi] = -30
        unary[lo:hi, kind + 1] = 0
        taken[lo:hi] = True
    if taken.all():
        return []
    belief = field.beliefs(np.concatenate((unary, np.zeros((g.hubs, len(LABELS))))), g.edges, g.kinds)[: len(g.at)]
    out: list[list[int]] = []
    last = -2
    for k in np.flatnonzero(~taken & (belief[:, 1:].max(axis=1) > BELIEF)).tolist():
        kind = int(belief[k, 1:].argmax())
        a, b = g.spans[k]
        core = text[a:b]
        a += len(core) - len(core.lstrip(".,;:!?\"'<>[]"))
        b -= len(core) - len(core.rstrip(".,;:!?\"'<>[]"))
        if a >= b:
            continue
        if out and last == k - 1 and g.at[k] == g.at[k - 1] + 1 and out[-1][1] == kind == 3:
            out[-1][2] = b  # parts of one phone number
        else:
            out.append([a, kind, b])
        last = k
    return [tuple(x) for x in out]


def all_spans(text: str, field: Field) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(base, base and further ones), sorted by start, then kind."""
    base = base_spans(text)
    return base, sorted(base + further_spans(text, base, field))


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans): counts and digest of the base spans, and all spans."""

    def each(batches):
        field = trained()
        for ids, texts in text_slices(batches):
            rows = []
            for doc, text in zip(ids, texts, strict=True):
                base, spans = all_spans(text, field)
                rows.append((doc, *[sum(k == n for _, k, _ in base) for n in range(4)], hashlib.sha256(written(base).encode()).hexdigest(), written(spans)))
            columns = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:5]], pa.array(columns[5]), pa.array(columns[6], pa.string())], ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return id_and_text(docs, id_col, text_col).mapInArrow(each, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Each span as its kind in brackets; of overlapping ones the first names the stretch."""
    out, end = [], 0
    for a, k, b in spans:
        if a >= end:
            out += [text[end:a], f"[{KINDS[k].upper()}]"]
            end = b
        elif b > end:
            end = b
    return "".join([*out, text[end:]])


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with personal data masked; n_chars, if there is one, follows the text, which stays null where it is null."""
    schema = docs.schema
    place, chars = docs.columns.index(text_col), docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def each(batches):
        field = trained()
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                texts = batch.column(place).to_pylist()
                new = [t if t is None or not (s := all_spans(t, field)[1]) else masked(t, s) for t in texts]
                columns = list(batch.columns)
                columns[place] = pa.array(new, pa.string())
                if chars is not None:
                    kept = columns[chars].to_pylist()
                    columns[chars] = pa.array([n if a is b or a == b else len(b) for n, a, b in zip(kept, texts, new, strict=True)], columns[chars].type)
                yield pa.RecordBatch.from_arrays(columns, schema=whole.schema)

    return docs.mapInArrow(each, schema)
