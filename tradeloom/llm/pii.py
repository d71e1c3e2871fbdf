"""Personal data by weak supervision.

Candidates are found by fixed patterns and by wider ones (secrets, local phone numbers, bank accounts, social security
numbers). Four labelers vote on each: the exact form (``form``), lists of known beginnings and endings (``list``), words
in front of it (``context``) and its mixture of characters (``shape``). A vote is -1, 0 or 1. Spark counts how often each
(kind, votes, form features) occurs; that table has a bounded number of rows. Expectation-maximisation over it estimates,
per kind, how reliable each labeler is, and the posteriors train a logistic span classifier on votes and form features.
Spans of the fixed patterns always stay; further ones are added when the classifier gives one half or more.

Texts are read once: the candidates of a document are kept beside its id, and everything later works on them.

Cases: a null or empty text has no spans. Candidates that overlap one of the fixed patterns, or an earlier added span,
are not added. Repeated rows are judged one by one; only the id and the text are read. Without candidates the classifier
adds nothing.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.common import sha256_hex, slices

BASE = ("email", "ip", "card", "phone")
ADDED = ("iban", "ssn", "localphone", "secret")
KINDS = BASE + ADDED
VOTERS = ("form", "list", "context", "shape")
NEAR = 28  # characters in front of a span that the context labeler reads

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits in which a match failed from its first digit cannot hold one that starts later in the run.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
FURTHER = {
    "iban": re.compile(r"\b[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}\b", re.A),
    "ssn": re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "localphone": re.compile(r"(?<![0-9+])\(?[0-9]{3,4}\)?[ .-][0-9]{3,4}[ .-][0-9]{3,4}(?![0-9])"),
    # A token of at least 16 characters with a letter and a digit anywhere in it, of any length: the lookaheads cannot
    # leave the token, and candidates start only where a token starts, so the search stays linear.
    "secret": re.compile(r"(?<![A-Za-z0-9_/+-])(?=[A-Za-z_/+-]*[0-9])(?=[0-9_/+-]*[A-Za-z])[A-Za-z0-9_/+-]{16,}(?![A-Za-z0-9_/+-])"),
}

# Gazetteers of the list labeler.
TOP_DOMAINS = set("com org net edu gov info io de fr es uk it eu at ch be nl pt us ca mx ar co br au jp cn in".split())
CARD_STARTS = ("4", "51", "52", "53", "54", "55", "2221", "2720", "34", "37", "6011", "65", "35", "36", "38")
COUNTRY_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "5", "6", "8", "9")
IBAN_COUNTRIES = set("AT BE BG CH CY CZ DE DK EE ES FI FR GB GR HR HU IE IT LI LT LU LV MC MT NL NO PL PT RO SE SI SK SM".split())
SECRET_STARTS = ("AKIA", "ASIA", "ghp_", "gho_", "sk-", "sk_", "pk_", "xox", "eyJ", "AIza", "glpat-")
# Words of the context labeler in four languages, for and against.
CONTEXT = {
    "email": "mail email e-mail contact correo courriel kontakt write",
    "ip": "ip address server host adresse dirección client from",
    "card": "card visa mastercard credit karte carte tarjeta payment",
    "phone": "phone tel call mobile telefon téléphone teléfono fax",
    "iban": "iban account konto compte cuenta bank",
    "ssn": "ssn social security",
    "localphone": "phone tel call mobile telefon téléphone teléfono fax",
    "secret": "token password passwd pwd secret key apikey api_key auth bearer credential",
}
AGAINST = "version isbn issn doi page chapter order invoice release build commit sha figure section".split()


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of the address pattern; it looks from each ``@``, so time follows the length of the text."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        before = text[max(free, text.rfind("@", 0, at) + 1) : at]
        name = len(before) - len(before.rstrip(LOCAL))
        after = DOMAIN.match(text, at + 1) if name else None
        if after:
            free = after.end()
            out.append((at - name, free))
        at = text.find("@", at + 1)
    return out


def small(part: str) -> bool:
    """A string of digits that is 255 at most, whatever its length."""
    digits = part.lstrip("0")
    return len(digits) < 3 or (len(digits) == 3 and digits <= "255")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    spans = [("email", a, b) for a, b in emails(text)]
    spans += [("ip", *m.span()) for m in IP.finditer(text) if all(map(small, m.group().split(".")))]
    for m in CARD.finditer(text):
        if 13 <= len(m.group()) <= 38:
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 9 <= sum(c in "0123456789" for c in m.group()) <= 15:
            spans.append(("phone", *m.span()))
    return spans


def candidates(text: str) -> tuple[list, list]:
    """Fixed spans, and further candidates that touch none of them nor each other."""
    fixed = base_spans(text)
    taken = sorted((a, b) for _, a, b in fixed)
    more = []
    for rank, kind in enumerate(ADDED):
        more += [(m.start(), rank, m.end(), kind) for m in FURTHER[kind].finditer(text)]
    added, end, i = [], -1, 0
    for a, _, b, kind in sorted(more):
        while i < len(taken) and taken[i][1] <= a:
            i += 1
        if a >= end and not (i < len(taken) and taken[i][0] < b):
            added.append((kind, a, b))
            end = b
    return fixed, added


def _listed(kind: str, value: str, digits: str) -> int:
    if kind == "email":
        return 1 if value.rpartition(".")[2].lower() in TOP_DOMAINS else -1
    if kind == "ip":
        return -1 if value.split(".")[0].lstrip("0") in ("", "127", "255") else 1
    if kind == "card":
        return 1 if digits.startswith(CARD_STARTS) else -1
    if kind == "phone":
        return 1 if digits.startswith(COUNTRY_CODES) else -1
    if kind == "iban":
        return 1 if value[:2] in IBAN_COUNTRIES else -1
    if kind == "secret":
        return 1 if value.startswith(SECRET_STARTS) else 0
    return 0


def _formed(kind: str, value: str, digits: str) -> int:
    if kind == "email":
        return 1 if re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9.-]{3,190}\.[A-Za-z]{2,}", value) else -1
    if kind == "ip":
        return 1 if all(p == str(int(p[-4:])) for p in value.split(".")) else -1
    if kind == "iban":
        turned = "".join(str(int(c, 36)) for c in value[4:] + value[:4])
        return 1 if int(turned) % 97 == 1 else -1
    if kind == "ssn":
        return -1 if digits[:3] in ("000", "666") or digits[3:5] == "00" or digits[5:] == "0000" else 1
    if kind == "localphone":
        return 1 if 9 <= len(digits) <= 11 else -1
    if kind == "secret":
        exact = re.fullmatch(r"[0-9a-f]{16}|[0-9a-f]{18}|[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64}|(AKIA|ASIA)[A-Z0-9]{16}", value)
        return 1 if exact else -1
    return 1


def _shaped(value: str, digits: str) -> int:
    """Many different characters with letters and digits mixed, or digits alone, speak for a span."""
    letters = sum(c.isalpha() for c in value)
    if not letters:
        return 1 if len(set(digits)) > 3 else -1
    turns = sum(a.isdigit() != b.isdigit() for a, b in zip(value, value[1:]))
    return 1 if turns >= 4 else (0 if turns >= 2 else -1)


def describe(text: str, kind: str, start: int, end: int) -> tuple[int, int]:
    """The votes of a candidate and its form features, each packed into one number."""
    value = text[start:end]
    digits = "".join(c for c in value if c in "0123456789")
    front = text[max(0, start - NEAR) : start].lower()
    near = set(re.findall(r"[^\W\d]+", front))
    context = 1 if near & set(CONTEXT[kind].split()) else (-1 if near & set(AGAINST) else 0)
    code = 0
    for v in (_formed(kind, value, digits), _listed(kind, value, digits), context, _shaped(value, digits)):
        code = 3 * code + v + 1
    length = min(3, len(value) // 12)
    ratio = min(3, 4 * len(digits) // len(value))
    lead = 2 if front.endswith(("=", '="', ":", ": ", '= "')) else (1 if front.endswith((" ", "\n")) or not front else 0)
    upper = int(any(c.isupper() for c in value))
    return code, ((length * 4 + ratio) * 3 + lead) * 2 + upper


FOUND = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
    "kinds array<int>, starts array<int>, ends array<int>, votes array<int>, forms array<int>"
)


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, 1):
            counts: list[list[int]] = []
            fields: list[list] = [[] for _ in range(5)]
            for text in part.column(1).to_pylist():
                fixed, added = candidates(text or "")
                spans = sorted((KINDS.index(k), a, b) for k, a, b in (*fixed, *added))
                counts.append([sum(s[0] == i for s in spans) for i in range(4)])
                told = [describe(text, KINDS[k], a, b) for k, a, b in spans]
                for out, values in zip(fields, ([s[0] for s in spans], [s[1] for s in spans], [s[2] for s in spans], [t[0] for t in told], [t[1] for t in told])):
                    out.append(values)
            arrays = [part.column(0), *(pa.array(x, pa.int64()) for x in zip(*counts))]
            arrays += [pa.array(x, pa.list_(pa.int32())) for x in fields]
            names = ["doc_id", *(f"n_{k}" for k in BASE), "kinds", "starts", "ends", "votes", "forms"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: how many fixed spans of each kind, and all candidates in parallel arrays."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_find, FOUND)


@dataclass
class Labelers:
    """What was learned: reliabilities by kind, and the weights of the span classifier by kind."""

    prior: dict[int, float] = field(default_factory=dict)
    reliability: dict[int, np.ndarray] = field(default_factory=dict)  # [class, labeler, vote + 1]
    weights: dict[int, np.ndarray] = field(default_factory=dict)

    def accepted(self) -> list[tuple[int, int, int]]:
        """Every (kind, votes, form) of the added kinds that the classifier accepts."""
        out = []
        for kind, w in self.weights.items():
            if kind >= len(BASE):
                grid = [(v, f) for v in range(3 ** len(VOTERS)) for f in range(96)]
                p = 1 / (1 + np.exp(-np.clip(_features(grid) @ w, -30, 30)))
                out += [(kind, v, f) for (v, f), x in zip(grid, p) if x >= 0.5]
        return out


def _votes(code: np.ndarray) -> np.ndarray:
    return np.stack([code // 3 ** (len(VOTERS) - 1 - j) % 3 for j in range(len(VOTERS))], 1)


def _features(rows: list[tuple[int, int]]) -> np.ndarray:
    """One column for each value of each vote and each form feature, and one that is always 1."""
    votes, forms = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    parts = [np.eye(3)[v] for v in _votes(votes).T]
    parts += [np.eye(4)[forms // 24], np.eye(4)[forms // 6 % 4], np.eye(3)[forms // 2 % 3], np.eye(2)[forms % 2]]
    return np.hstack([*parts, np.ones((len(rows), 1))])


def learn(found: DataFrame, rounds: int = 50) -> Labelers:
    """Expectation-maximisation and the span classifier, from the counts of (kind, votes, form) over all documents."""
    each = F.explode(F.arrays_zip("kinds", "votes", "forms"))
    table = found.select(each.alias("c")).groupBy("c.kinds", "c.votes", "c.forms").agg(F.count("*").alias("n")).collect()
    out = Labelers()
    for kind in sorted({r.kinds for r in table}):
        rows = [r for r in table if r.kinds == kind]
        n = np.array([r.n for r in rows], float)
        votes = _votes(np.array([r.votes for r in rows]))
        # Start from the majority of the votes; a little is added to every count, more on the side a vote argues for.
        post = 1 / (1 + np.exp(-1.5 * (votes - 1).sum(1)))
        hope = np.array([[[2.0, 1.0, 0.5]] * len(VOTERS), [[0.5, 1.0, 2.0]] * len(VOTERS)])
        for _ in range(rounds):
            weight = np.stack([(1 - post) * n, post * n])
            prior = (weight[1].sum() + 1) / (n.sum() + 2)
            theta = hope.copy()
            for j in range(len(VOTERS)):
                for v in range(3):
                    theta[:, j, v] += weight[:, votes[:, j] == v].sum(1)
            theta /= theta.sum(2, keepdims=True)
            score = np.log([1 - prior, prior])[:, None] + sum(np.log(theta[:, j, votes[:, j]]) for j in range(len(VOTERS)))
            post = 1 / (1 + np.exp(np.clip(score[0] - score[1], -30, 30)))
        out.prior[kind], out.reliability[kind] = float(prior), theta
        x = _features([(r.votes, r.forms) for r in rows])
        w, scale = np.zeros(x.shape[1]), n / n.sum()
        for _ in range(25):  # Newton's method with a small ridge
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            slope = x.T @ (scale * (p - post)) + 1e-3 * w
            curve = (x * (scale * p * (1 - p) + 1e-9)[:, None]).T @ x + 1e-3 * np.eye(len(w))
            w -= np.linalg.solve(curve, slope)
        out.weights[kind] = w
    return out


def _decide(model: Labelers):
    accepted = set(model.accepted())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            col = batch.to_pydict()
            base, spans = [], []
            for kinds, starts, ends, votes, forms in zip(*(col[c] for c in ("kinds", "starts", "ends", "votes", "forms"))):
                fixed = [(k, a, b) for k, a, b in zip(kinds, starts, ends) if k < len(BASE)]
                kept = [(k, a, b) for k, a, b, v, f in zip(kinds, starts, ends, votes, forms) if k < len(BASE) or (k, v, f) in accepted]
                base.append(sha256_hex(joined(fixed).encode()))
                spans.append(joined(kept))
            arrays = [batch.column(i) for i in range(5)] + [pa.array(base, pa.string()), pa.array(spans, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names[:5], "base_sha256", "spans"])

    return run


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def decide(found: DataFrame, model: Labelers) -> DataFrame:
    """``doc_id``, counts, ``base_sha256`` and ``spans``, each span as kind:start:end."""
    kinds = FOUND[: FOUND.index(", kinds")] + ", base_sha256 string, spans string"
    return found.mapInArrow(_decide(model), kinds)


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span (kind, start, end) replaced by its kind in angle brackets; of overlapping spans the one
    that starts first, then the longest, names the whole stretch."""
    out, at = [], 0
    for a, b, kind in sorted((a, -b, kind) for kind, a, b in spans):
        if a >= at:
            out += [text[at:a], f"<{KINDS[kind]}>"]
        at = max(at, -b)
    return "".join(out) + text[at:]


def redacted(docs: DataFrame, model: Labelers, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with accepted spans replaced. Spans are found again, which is cheaper than a join of texts."""
    accepted, place = set(model.accepted()), docs.columns.index(text_col)

    def clean(text: str | None) -> str | None:
        fixed, added = candidates(text or "")
        spans = [(KINDS.index(k), a, b) for k, a, b in fixed]
        spans += [(KINDS.index(k), a, b) for k, a, b in added if (KINDS.index(k), *describe(text, k, a, b)) in accepted]
        return redact(text, spans) if spans else text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, place):
                texts = pa.array([clean(t) for t in part.column(place).to_pylist()], pa.string())
                yield part.set_column(place, part.schema.names[place], texts)

    return docs.mapInArrow(run, docs.schema)
