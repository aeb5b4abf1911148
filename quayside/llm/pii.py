"""Personal data by weak supervision: labelers vote on candidate spans, EM weighs the labelers, a classifier decides.

Candidates are the base patterns, which always count, and wider patterns of each kind (numbers without a plus sign,
addresses written with "at" and "dot", digit groups that fail a check, credentials). On each candidate three
labelers vote for, against or not at all: the strict pattern with its check digits, gazetteers (endings of domains,
calling codes, card prefixes, key prefixes), and the words around it. Expectation-maximisation over the counts of vote
patterns estimates how reliable each labeler is for each kind, and a logistic classifier per kind is trained on the
posteriors with the votes and the span's shape as features. It decides on the candidates that the base doesn't have.

The votes of all candidates of all documents are counted; the counts, at most ``len(KINDS)`` x 27 x shapes rows, are
all that reaches the driver. Texts are scanned whole, each pattern in time linear in the text.

Defined results: null and empty texts have no spans; spans are ordered by kind, start and end, and a span of a kind
that overlaps one of the same kind before it is left out, base spans first; ties and repeated rows get equal
results; an empty table gives an empty result and a classifier that adds nothing. Only key and text are read;
``redact`` passes all other columns through.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from quayside.llm import common

#: Kinds in the order of the digest; ``secret`` has no base pattern.
KINDS = ("email", "ip", "card", "phone", "secret")
BASE_KINDS = KINDS[:4]

# The base patterns. Each is anchored so that a search that fails is not tried again inside the same run
# of characters, where it would fail alike; the matches are those of the plain pattern.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile("[0-9]")

# Wider patterns, gazetteers and context words.
_WIDE = {
    "email": re.compile(r"\b[A-Za-z0-9._%+-]{1,64} ?(?:\(at\)|\[at\]|\{at\}) ?[A-Za-z0-9-]{1,63}"
                        r"(?: ?(?:\.|\(dot\)|\[dot\]|\{dot\}) ?[A-Za-z0-9-]{1,63}){1,4}", re.A),
    "phone": re.compile(r"(?<![\w+.-])(?:\([0-9]{2,4}\) ?|0[0-9]{1,4}[ /-])[0-9]{2,4}(?:[ .-][0-9]{2,4}){1,3}(?![\w-])", re.A),
    "card": re.compile(r"(?<![0-9 -])[0-9]{4}(?:[ -][0-9]{4}){3}(?![0-9 -])"),
    "secret": re.compile(r"(?<!\w)(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,64}|"
                         r"xox[abprs]-[A-Za-z0-9-]{10,72}|[A-Fa-f0-9]{32,64}|[A-Za-z0-9+/]{40})(?!\w)|"
                         r"(?<=password=)[^\s\"']{6,}", re.A),
}
ENDINGS = frozenset("com org net edu gov io info eu uk de fr es it nl ch at us ca au".split())
CALLING_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48",
                 "49", "51", "52", "54", "55", "56", "57", "60", "61", "62", "63", "64", "65", "66", "81", "82", "86", "90", "91")
CARD_PREFIXES = ("34", "35", "36", "37", "4", "51", "52", "53", "54", "55", "60", "62", "65")
KEY_PREFIXES = ("AKIA", "ASIA", "ghp_", "gho_", "sk-", "xox")
CONTEXT = {
    "email": frozenset("mail email e-mail contact write address".split()),
    "ip": frozenset("ip host server address login from".split()),
    "card": frozenset("card visa mastercard amex payment credit iban".split()),
    "phone": frozenset("phone tel telephone call mobile fax cell".split()),
    "secret": frozenset("password passwd token key secret api apikey credentials".split()),
}
AGAINST = frozenset("version release isbn issn order invoice page pages section chapter license figure".split())
WINDOW = 40

LABELERS = 3
PRIOR = 0.5
EM_STEPS = 200
ACCEPT = 0.5

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 else 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str):
    """Leftmost non-overlapping addresses: the local part runs back from each at sign."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            end = m.end()
        at = text.find("@", at + 1)


def base_spans(text: str) -> list[Span]:
    """The base spans of a text by kind, then start."""
    found: list[Span] = [("email", s, e) for s, e in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return found
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 37 and 16 <= len(d := _digits(m[0])) <= 19 and luhn(d):
            found.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_digits(m[0])) <= 15:
                found.append(("phone", m.start(), m.end()))
    return found


def wide_spans(text: str) -> list[Span]:
    """Candidates beside the base, some of which may overlap it."""
    found = []
    digit = bool(_DIGIT.search(text))
    for kind, pattern in _WIDE.items():
        if not digit and kind in ("phone", "card") or kind == "email" and "at)" not in text and "at]" not in text and "at}" not in text:
            continue
        found += [(kind, m.start(), m.end()) for m in pattern.finditer(text)]
    return found


def _context_vote(kind: str, text: str, start: int, end: int) -> int:
    near = set(re.findall(r"[a-z-]+", text[max(0, start - WINDOW):start].lower() + " " + text[end:end + WINDOW].lower()))
    return 1 if near & CONTEXT[kind] else -1 if near & AGAINST else 0


def _strict_vote(kind: str, value: str) -> int:
    digits = _digits(value)
    if kind == "email":
        return 1 if value.count("@") == 1 and ".." not in value else 0
    if kind == "ip":
        return 1 if not any(p.startswith("0") and len(p) > 1 for p in value.split(".")) else -1
    if kind == "card":
        return 1 if 13 <= len(digits) <= 19 and luhn(digits) else -1
    if kind == "phone":
        return 1 if value.startswith("+") and 10 <= len(digits) <= 15 else -1 if len(digits) < 8 else 0
    return 1 if len(set(value)) >= 8 and any(c.isdigit() for c in value) else -1


def _gazetteer_vote(kind: str, value: str, base: bool) -> int:
    if kind == "email":
        return 1 if re.split(r"\W+", value)[-1].lower() in ENDINGS else 0
    if kind == "ip":
        return -1 if value.startswith(("0.", "255.")) else 1 if value.startswith(("10.", "192.168.", "127.")) else 0
    if kind == "card":
        return 1 if _digits(value).startswith(CARD_PREFIXES) else -1
    if kind == "phone":
        return (1 if value[1:].startswith(CALLING_CODES) else -1) if value.startswith("+") else 0
    return 1 if value.startswith(KEY_PREFIXES) else 0


def _shape(value: str) -> tuple[int, int, int]:
    """Length, separators and share of digits, each in few steps."""
    share = len(_digits(value)) / max(len(value), 1)
    return min(len(value) // 8, 4), min(sum(not c.isalnum() for c in value), 3), int(share >= 0.9) + int(share >= 0.3)


def candidates(text: str) -> list[tuple[Span, bool, tuple[int, ...]]]:
    """(span, whether the base has it, votes and shape) of a text: base spans, then wider ones that don't overlap a
    span of their kind before them."""
    base = base_spans(text)
    taken = {k: [(s, e) for kind, s, e in base if kind == k] for k in KINDS}
    out = [(span, True) for span in base]
    for kind, s, e in wide_spans(text):
        if not any(s < e2 and s2 < e for s2, e2 in taken[kind]):
            taken[kind].append((s, e))
            out.append(((kind, s, e), False))
    return [((k, s, e), is_base, (_strict_vote(k, text[s:e]), _gazetteer_vote(k, text[s:e], is_base),
                                  _context_vote(k, text, s, e), *_shape(text[s:e]))) for (k, s, e), is_base in out]


@dataclass
class Model:
    """What EM and the classifier learned, by kind."""

    prior: dict[str, float] = field(default_factory=dict)
    reliability: dict[str, np.ndarray] = field(default_factory=dict)  # labeler x class x vote
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    def probability(self, kind: str, pattern: tuple[int, ...]) -> float:
        w = self.weights.get(kind)
        return 0.0 if w is None else float(1 / (1 + np.exp(-np.clip(_row(pattern) @ w, -30, 30))))

    def spans(self, text: str | None) -> list[Span]:
        """Base spans and the accepted candidates, by kind, start and end."""
        if not text:
            return []
        kept = [span for span, base, pattern in candidates(text) if base or self.probability(span[0], pattern) >= ACCEPT]
        return sorted(kept, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def _row(pattern: tuple[int, ...]) -> np.ndarray:
    votes, (length, separators, share) = pattern[:LABELERS], pattern[LABELERS:]
    one_hot = [float(v == x) for v in votes for x in (-1, 1)]
    return np.array([*one_hot, length / 4, separators / 3, share / 2, 1.0])


def em(votes: np.ndarray, n: np.ndarray, steps: int = EM_STEPS) -> tuple[float, np.ndarray, np.ndarray]:
    """Share of true spans, labeler reliabilities [labeler, class, vote + 1] and posteriors, from vote patterns and
    their counts. Dirichlet priors hold that a labeler is right more often than wrong, which fixes which class is which."""
    # as weighty as a share of the data, or two groups of true spans that different labelers find become the classes
    strength = max(1.0, PRIOR * n.sum() / 7)
    pseudo = strength * np.tile(np.array([[3.0, 3.0, 1.0], [1.0, 3.0, 3.0]]), (votes.shape[1], 1, 1))
    theta, share = pseudo / pseudo.sum(2, keepdims=True), 0.5
    for _ in range(steps):
        log = np.log([1 - share, share]) + sum(np.log(theta[j][:, votes[:, j] + 1]).T for j in range(votes.shape[1]))
        posterior = np.exp(log - log.max(1, keepdims=True))
        posterior /= posterior.sum(1, keepdims=True)
        weight = posterior * n[:, None]
        share = (weight[:, 1].sum() + 1) / (n.sum() + 2)
        new = pseudo.copy()
        for j in range(votes.shape[1]):
            for v in range(3):
                new[j, :, v] += weight[votes[:, j] == v - 1].sum(0)
        new /= new.sum(2, keepdims=True)
        done, theta = np.abs(new - theta).max() < 1e-9, new
        if done:
            break
    return float(share), theta, posterior[:, 1]


def train(counts: list[tuple[str, tuple[int, ...], int]]) -> Model:
    """EM and classifiers from (kind, votes and shape, count)."""
    from quayside.llm.toxicity import logistic

    model = Model()
    for kind in KINDS:
        mine = sorted((p, n) for k, p, n in counts if k == kind)
        if not mine:
            continue
        patterns, n = [p for p, _ in mine], np.array([c for _, c in mine], float)
        share, theta, posterior = em(np.array([p[:LABELERS] for p in patterns]), n)
        x = np.array([_row(p)[:-1] for p in patterns])
        model.prior[kind], model.reliability[kind] = share, theta
        model.weights[kind] = logistic(x, posterior, n / n.sum() * min(n.sum(), 1000.0))
    return model


_COUNTS = "kind string, pattern array<int>, n bigint"


def fit(docs: DataFrame, text: str = "text") -> Model:
    """Count the vote patterns of all candidates of all documents, then train."""
    common.bounded_batches(docs.sparkSession)

    @common.handing_back
    def count(batches):
        for pdf in batches:
            seen = Counter((span[0], pattern) for t in pdf["text"] if t for span, _, pattern in candidates(t))
            if seen:
                yield pd.DataFrame([(k, list(p), n) for (k, p), n in seen.items()], columns=["kind", "pattern", "n"])

    rows = docs.select(F.col(text).alias("text")).mapInPandas(count, _COUNTS)
    total = rows.groupBy("kind", "pattern").agg(F.sum("n").alias("n")).collect()  # kinds x votes x shapes at most
    return train([(r["kind"], tuple(r["pattern"]), r["n"]) for r in total])


SPANS = ArrayType(StructType([StructField("kind", StringType()), StructField("start", IntegerType()),
                              StructField("end", IntegerType())]))


def find_spans(docs: DataFrame, model: Model, text: str = "text", name: str = "pii_spans") -> DataFrame:
    """``docs`` with a column of spans (kind, start, end in code points)."""
    schema = StructType([*docs.schema.fields, StructField(name, SPANS)])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    make = lambda t, s: [{"kind": k, "start": a, "end": b} for k, a, b in s]
    return _with_column(docs, model, text, schema, kind, make)


def redact(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets; overlapping spans by that of the first."""
    def replace(body, spans):
        if body is None:
            return None
        out, last = [], 0
        for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
            if start >= last:
                out += [body[last:start], f"[{kind.upper()}]"]
            last = max(last, end)
        return "".join([*out, body[last:]]) if out else body

    fields = [StructField(f.name, StringType()) if f.name == text else f for f in docs.schema.fields]
    return _with_column(docs, model, text, StructType(fields), pa.string(), replace, at=docs.columns.index(text))


def _with_column(docs, model, text, schema, kind, make, at=None):
    spark = docs.sparkSession
    common.bounded_batches(spark)
    shared, source, names = spark.sparkContext.broadcast(model), docs.columns.index(text), [f.name for f in schema.fields]

    @common.handing_back
    def run(batches):
        own = shared.value
        for b in batches:
            new = pa.array([make(t, own.spans(t)) for t in b.column(source).to_pylist()], kind)
            columns = [*b.columns, new] if at is None else [*b.columns[:at], new, *b.columns[at + 1:]]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(run, schema)


def digest(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def summarise(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_email, n_ip, n_card, n_phone, base_sha256, spans): counts and digest of the base spans, and all spans."""
    spark = docs.sparkSession
    common.bounded_batches(spark)
    shared = spark.sparkContext.broadcast(model)

    @common.handing_back
    def run(batches):
        for pdf in batches:
            out = []
            for k, t in zip(pdf["key"], pdf["text"]):
                base = base_spans(t or "")
                of = Counter(s[0] for s in base)
                out.append((k, *[of[x] for x in BASE_KINDS], hashlib.sha256(digest(base).encode()).hexdigest(),
                            digest(shared.value.spans(t))))
            yield pd.DataFrame(out, columns=["key", *[f"n_{x}" for x in BASE_KINDS], "base_sha256", "spans"])

    kind = docs.schema[key].dataType.simpleString()
    counts = ", ".join(f"n_{x} bigint" for x in BASE_KINDS)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return rows.mapInPandas(run, f"key {kind}, {counts}, base_sha256 string, spans string").withColumnRenamed("key", key)
