"""Personal data by weak supervision.

Spans of the base kinds (email, ip, card, phone) are found by pattern and
validity check and always reported. Further candidates (addresses with a
written-out "at", phone numbers without a plus sign, national numbers, names
after a title) are looser; regex, gazetteer and context labelers vote on each
candidate: for, against, or not at all. Expectation-maximisation over the
counts of all vote patterns of the corpus estimates how reliable each labeler
is, with the base spans as known cases for and the base matches that fail their
check as known cases against; a logistic span classifier is then fitted to the
resulting probabilities and decides on every candidate.

Counts cover the whole corpus and are summed by Spark; what the driver fits on
is a row per vote pattern (at most kinds x 3**labelers), not per span.

Defined results: a null text is empty; positions are code points, ends
exclusive; null ids stay; repeated rows give repeated rows; an empty table gives
an empty result; further columns are ignored (``redact`` returns them).
"""

from __future__ import annotations

import bisect
import itertools
import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtally.llm.common import materialize

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "email_words", "phone_local", "national_id", "name")
LABELERS = ("format", "gazetteer", "cue", "surroundings", "near_base")
#: A candidate becomes a span from this probability on.
ACCEPT = 0.9
#: Characters before (and half as many after) a span that the context labelers read.
CONTEXT = 48
#: A labeler's vote is taken to be right this many times, and wrong once, before any evidence.
PRIOR = (8.0, 1.0)

_ANY = re.compile(r"[0-9@]|\b(?:at|AT|At|[Dd]ot|Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Madame|Monsieur|Señor|Señora)\b")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_EMAIL_WORDS = re.compile(r"(?<![\w.])[A-Za-z0-9][\w.+-]{0,63}\s?(?:\(at\)|\[at\]|\sat\s)\s?[A-Za-z0-9-]{1,63}\s?(?:\(dot\)|\[dot\]|\sdot\s)\s?[A-Za-z]{2,10}\b", re.A)
_PHONE_LOCAL = re.compile(r"(?<![\w+.-])(?:\([0-9]{2,5}\)|[0-9]{2,5})[ ./-][0-9]{3,4}[ .-][0-9]{4}(?![\w-])", re.A)
_NATIONAL = re.compile(r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])", re.A)
_NAME = re.compile(r"\b(?:Mr|Mrs|Ms|Dr|Prof|Herr|Frau|Madame|Monsieur|Señor|Señora)\.? [A-ZÀ-Þ][a-zß-ÿ]+(?: [A-ZÀ-Þ][a-zß-ÿ]+)?")
#: Cue words, mail and domain names, first names.
_CUES = {"email_words": "mail email write contact reach address kontakt correo courriel", "phone_local": "call phone tel telephone mobile fax cell whatsapp telefon teléfono téléphone anrufen",
         "national_id": "ssn social security number id passport tax ausweis identidad", "name": "name signed regards dear contact von by from"}
_CUE = {k: re.compile(r"\b(?:" + "|".join(v.split()) + r")\b", re.I) for k, v in _CUES.items()}
_DOMAINS = frozenset("com org net edu gov io de fr es uk info".split())
_FIRST = frozenset("james john robert michael mary patricia jennifer linda anna maria jose juan pierre marie hans peter klaus thomas david sarah laura paul".split())


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def base_spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """(spans, matches that fail their check), by kind as listed, then start.

    Every scan is linear: an address is found from its "@" leftwards, and a
    number only from the first digit of a run.
    """
    found: list[tuple[str, int, int]] = []
    failed: list[tuple[str, int, int]] = []
    done = 0
    if "@" in text:
        for m in _AT.finditer(text):
            begin = m.start()
            while begin > done and text[begin - 1] in _LOCAL:
                begin -= 1
            if begin < m.start():
                done = m.end()
                found.append(("email", begin, done))
    for m in _IP.finditer(text):
        ok = all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split("."))
        (found if ok else failed).append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m.group().replace(" ", "").replace("-", "")
        if 13 <= len(digits) <= 19:
            (found if luhn(digits) else failed).append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            n = sum(c.isdigit() for c in m.group())
            (found if 9 <= n <= 15 else failed).append(("phone", *m.span()))
    return found, failed


def candidates(text: str, taken: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Loose candidates that touch no span of ``taken``, leftmost first per kind."""
    spans = sorted((b, e) for _, b, e in taken)
    starts = [b for b, _ in spans]
    reach = list(itertools.accumulate((e for _, e in spans), max))  # the greatest end so far
    out = []
    for kind, pattern in (("email_words", _EMAIL_WORDS), ("phone_local", _PHONE_LOCAL), ("national_id", _NATIONAL), ("name", _NAME)):
        for m in pattern.finditer(text):
            b, e = m.span()
            i = bisect.bisect_left(starts, e)
            if not i or reach[i - 1] <= b:
                out.append((kind, b, e))
    return out


def votes(text: str, kind: str, begin: int, end: int, base_starts: list[int]) -> tuple[int, ...]:
    """The labelers' votes on a span: 1 for, -1 against, 0 none."""
    span, before, after = text[begin:end], text[max(0, begin - CONTEXT):begin], text[end:end + CONTEXT // 2]
    digits = [c for c in span if c.isdigit()]
    form = {"email": 1, "email_words": 1, "name": 0, "ip": 1 if all(len(p) <= 3 for p in span.split(".")) else -1,
            "card": 1 if len(digits) >= 13 and luhn("".join(digits)) else -1, "phone": 1 if 9 <= len(digits) <= 15 else -1,
            "phone_local": 1 if 9 <= len(digits) <= 12 else -1,
            "national_id": -1 if span[:3] in ("000", "666") or span[:1] == "9" or span[4:6] == "00" or span[7:] == "0000" else 1}[kind]
    words = re.findall(r"[^\W\d_]+", span.lower())
    if kind in ("email", "email_words"):
        gazetteer = 1 if words and words[-1] in _DOMAINS else -1
    elif kind == "name":
        gazetteer = 1 if any(w in _FIRST for w in words) else 0
    elif kind == "card":
        gazetteer = 1 if span[:1] in "3456" else -1
    else:
        gazetteer = 0 if len(set(digits)) > 3 else -1
    cue = 1 if kind in _CUE and _CUE[kind].search(before) else 0
    numeric = sum(c.isdigit() for c in before[-16:] + after[:16])
    around = -1 if numeric > 6 or after[:1].isalnum() or before[-1:].isalnum() else 0
    i = bisect.bisect_left(base_starts, begin - 200)
    near = 1 if i < len(base_starts) and base_starts[i] < end + 200 and kind not in BASE else 0
    return form, gazetteer, cue, around, near


class Model:
    """Labeler reliabilities and the span classifier, as plain numbers."""

    def __init__(self, reliability: dict[str, tuple[float, float]], weights: list[float], probability: dict[tuple, float]):
        self.reliability, self.weights, self.probability = reliability, weights, probability

    def accepts(self, kind: str, vote: tuple[int, ...]) -> bool:
        return self.score(kind, vote) >= ACCEPT

    def score(self, kind: str, vote: tuple[int, ...]) -> float:
        return float(1 / (1 + np.exp(-_features(kind, vote) @ np.array(self.weights))))


def _features(kind: str, vote: tuple[int, ...]) -> np.ndarray:
    return np.array([1.0, *[float(v == 1) for v in vote], *[float(v == -1) for v in vote], *[float(kind == k) for k in KINDS[len(BASE):]]])


def fit(patterns: list[tuple[str, tuple[int, ...], int, int]], rounds: int = 60) -> Model:
    """``patterns``: (kind, votes, known: 1, 0 or -1 for unknown, count)."""
    if not patterns:
        return Model({}, [-10.0] + [0.0] * (2 * len(LABELERS) + len(KINDS) - len(BASE)), {})
    patterns = sorted(patterns)
    v = np.array([p[1] for p in patterns])
    known = np.array([p[2] for p in patterns])
    n = np.array([p[3] for p in patterns], float)
    # every candidate has its format already: the other votes tell candidates apart
    y = np.where(known >= 0, known, np.clip(0.4 + 0.25 * v[:, 1:].sum(axis=1), 0.05, 0.95)).astype(float)
    unknown = n * (known < 0)
    right, wrong = PRIOR
    for _ in range(rounds):
        prior = np.clip(((unknown * y).sum() + 1) / (unknown.sum() + 4), 1e-6, 1 - 1e-6)  # of candidates, not of known cases
        odds = np.full(len(n), np.log(prior / (1 - prior)))
        rates = []
        for j in range(v.shape[1]):
            like = []
            for weight, sign in ((n * y, 1), (n * (1 - y), -1)):
                agree, against, silent = ((weight * (v[:, j] == s)).sum() for s in (sign, -sign, 0))
                total = agree + against + silent + right + wrong + 1
                like.append({sign: (agree + right) / total, -sign: (against + wrong) / total, 0: (silent + 1) / total})
            rates.append((like[0][1], like[1][-1]))
            # silence says nothing about the span, only votes count
            odds += np.array([0.0 if s == 0 else np.log(like[0][s] / like[1][s]) for s in v[:, j]])
        new = np.where(known >= 0, known, 1 / (1 + np.exp(-np.clip(odds, -50, 50))))
        if np.abs(new - y).max() < 1e-6:
            break
        y = new
    x = np.array([_features(p[0], p[1]) for p in patterns])
    w = np.zeros(x.shape[1])
    scale = n / n.sum() * len(n)
    for _ in range(100):  # Newton steps with an L2 penalty
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (scale * (p - y)) + 0.01 * w
        curve = (x * (scale * p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return Model(dict(zip(LABELERS, rates)), w.tolist(), {(p[0], p[1]): float(q) for p, q in zip(patterns, y)})


def scan(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int, tuple[int, ...]]], Counter]:
    """(base spans, candidates with votes, vote patterns of all of them with what is known)."""
    if not _ANY.search(text):
        return [], [], Counter()
    found, failed = base_spans(text)
    starts = sorted(b for _, b, _ in found)
    more = [(k, b, e, votes(text, k, b, e, starts)) for k, b, e in candidates(text, found + failed)]
    seen: Counter = Counter()
    for spans, known in ((found, 1), (failed, 0)):
        for k, b, e in spans:
            seen[k, votes(text, k, b, e, starts), known] += 1
    for k, _, _, vote in more:
        seen[k, vote, -1] += 1
    return found, more, seen


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("votes", pa.string()), ("known", pa.int64()), ("n", pa.int64())])


def _scan_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            rows = []
            for text in part.column("text").to_pylist():
                found, more, seen = scan(text)
                rows.append([{"kind": k, "start": b, "stop": e, "votes": None, "known": 1, "n": 0} for k, b, e in found]
                            + [{"kind": k, "start": b, "stop": e, "votes": _text(v), "known": -1, "n": 0} for k, b, e, v in more]
                            + [{"kind": k, "start": -1, "stop": -1, "votes": _text(v), "known": z, "n": n} for (k, v, z), n in seen.items()])
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(rows, pa.list_(_SPAN))], names=["doc_id", "spans"])


_SPANS_DDL = "doc_id long, spans array<struct<kind: string, start: long, stop: long, votes: string, known: long, n: long>>"


def _text(vote: tuple[int, ...]) -> str:
    return "".join("-0+"[v + 1] for v in vote)


def _vote(text: str) -> tuple[int, ...]:
    return tuple("-0+".index(c) - 1 for c in text)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def scanned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's base spans, candidates and pattern counts, without the text."""
    return materialize(_rows(docs, id_col, text_col).mapInArrow(_scan_rows, _SPANS_DDL), "pii-scan")


def fit_corpus(scan_table: DataFrame) -> Model:
    """The model fitted on the pattern counts of all rows."""
    counts = (scan_table.select(F.explode("spans").alias("s")).where("s.start < 0")
              .groupBy("s.kind", "s.votes", "s.known").agg(F.sum("s.n").alias("n")).collect())
    return fit([(r["kind"], _vote(r["votes"]), r["known"], r["n"]) for r in counts])


def _joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{b}:{e}" for k, b, e in spans)


def _ordered(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1]))


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added."""
    table = scanned(docs, id_col, text_col)
    model = fit_corpus(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {f"n_{k}": [] for k in BASE} | {"base_sha256": [], "spans": [], "n_added": []}
            for spans in batch.column("spans").to_pylist():
                base = [(s["kind"], s["start"], s["stop"]) for s in spans if s["known"] == 1 and s["start"] >= 0]
                more = [(s["kind"], s["start"], s["stop"]) for s in spans if s["known"] == -1 and s["start"] >= 0 and model.accepts(s["kind"], _vote(s["votes"]))]
                n = Counter(k for k, _, _ in base)
                for k in BASE:
                    out[f"n_{k}"].append(n[k])
                out["base_sha256"].append(hashlib.sha256(_joined(_ordered(base)).encode()).hexdigest())
                out["spans"].append(_joined(_ordered(base + more)))
                out["n_added"].append(len(more))
            ids = batch.column("doc_id")
            yield pa.RecordBatch.from_arrays([ids, *[pa.array(c, pa.string() if k in ("base_sha256", "spans") else pa.int64()) for k, c in out.items()]],
                                             names=["doc_id", *out])

    return table.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets, such as [EMAIL];
    ``length_col``, if there, gets the new length. Null texts stay null."""
    model = fit_corpus(scanned(docs, id_col, text_col))

    def clean(text: str) -> str:
        found, more, _ = scan(text)
        spans = sorted([(b, e, k) for k, b, e in found] + [(b, e, k) for k, b, e, v in more if model.accepts(k, v)])
        out, at = [], 0
        for b, e, k in spans:
            if e > at:  # overlapping spans (a card in a phone number) give one gap
                if b >= at:
                    out += [text[at:b], f"[{k.upper()}]"]
                at = e
        return "".join(out) + text[at:]

    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [None if t is None else clean(t) for t in part.column(place).to_pylist()]
                yield part.set_column(place, part.schema.field(place).with_nullable(True), pa.array(texts, pa.string()))

    out = docs.withColumn(text_col, F.col(text_col).cast("string"))
    out = out.mapInArrow(run, out.schema)
    if length_col in docs.columns:
        out = out.withColumn(length_col, F.char_length(text_col).cast(dict(docs.dtypes)[length_col]))
    return out
