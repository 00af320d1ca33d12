"""Personal data: labelers vote on candidate spans, expectation-maximisation finds how far each is to be believed, and a
classifier of spans is trained on the result.

The four base kinds are fixed by their patterns and always stay. Further candidates (numbers, secrets, names, handles)
are kept where the classifier says so. All votes of all documents are counted by pattern of votes; there are at most
``len(KINDS + EXTRA) * 3 ** 5 * 6`` patterns, so the counts, not the documents, go to the driver. Texts are scanned
twice where they lie and never shuffled.
"""

import re
import string
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import words as W
from millrace.llm.shared import documents

KINDS = ("email", "ip", "card", "phone")
EXTRA = ("number", "secret", "name", "handle")
LABELERS = 5

# The patterns of the query contract.
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
# The same matches in time that grows with the text: a run of digits can only match from its start, an address only from
# the start of what stands before its @.
_IP = re.compile(r"(?<![0-9])" + PATTERNS["ip"].pattern)
_LOCAL = string.ascii_letters + string.digits + "._%+-"
_DOMAIN = re.compile(PATTERNS["email"].pattern.split("@")[1])
_NUMBER = re.compile(r"[0-9](?:[ ./-]?[0-9]){6,}")
_SECRET = re.compile(r"(?<![0-9A-Za-z_])(?=[0-9A-Za-z_]*[0-9])(?=[0-9A-Za-z_]*[A-Za-z])[0-9A-Za-z_]{20,}")
_HANDLE = re.compile(r"(?<![0-9A-Za-z._%+-])@[A-Za-z_][A-Za-z0-9_]{2,}")

# Gazetteers.
CUES = {
    "number": "account konto compte cuenta iban ssn passport ausweis passeport pasaporte id tax steuer nif dni number "
    "nummer tel phone telefon telephone call fax card karte carte tarjeta",
    "secret": "token key secret password passwort clave contraseña apikey bearer credential",
    "name": "mr mrs ms dr herr frau monsieur madame señor señora don doña name dear liebe cher querido by",
    "handle": "twitter follow user handle telegram insta",
    "email": "mail email e-mail contact kontakt write correo courriel",
    "ip": "ip host server address adresse dirección from",
    "card": "card karte carte tarjeta visa credit",
    "phone": "tel phone call telefon téléphone teléfono fax mobile",
}
GIVEN_NAMES = (
    "James Mary John Patricia Robert Jennifer Michael Linda William Elizabeth David Barbara Richard Susan Joseph Jessica "
    "Thomas Sarah Charles Karen Hans Peter Klaus Jürgen Ursula Monika Sabine Wolfgang Pierre Jean Marie Claude Michel "
    "Jacques Nathalie Isabelle José Carlos Carmen Antonio Manuel Dolores Javier Pilar"
)
_CUE_SETS = {kind: set(words.split()) for kind, words in CUES.items()}
_PLAIN = set("version chapter page figure section isbn volume seite kapitel abschnitt capítulo página chapitre".split())
_WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)?")
_NAME = re.compile(r"(?<!\w)(?:" + "|".join(GIVEN_NAMES.split()) + r")(?: [A-ZÀ-Þ][a-zß-ÿ]+){1,2}(?!\w)")
# Wider than _NAME: whatever stands before the name.
_NAMED = "(?:" + "|".join(GIVEN_NAMES.split()) + ") [A-ZÀ-Þ]"


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(map(int, reversed(digits))):
        total += d if k % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = done + len(text[done:at].rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        done = domain.end() if domain else at + 1
        at = text.find("@", done)


def _matches(kind: str, text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches of a base pattern."""
    if kind == "email":
        return _emails(text)
    return (m.span() for m in (_IP if kind == "ip" else PATTERNS[kind]).finditer(text))


def _byte(part: str) -> bool:
    value = part.lstrip("0")
    return len(value) <= 3 and int(value or "0") <= 255


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the four base kinds, by start and then by kind as listed."""
    out = []
    for order, kind in enumerate(PATTERNS):
        for start, end in _matches(kind, text):
            said = text[start:end]
            digits = re.sub("[^0-9]", "", said) if kind in ("card", "phone") else ""
            if (
                kind == "ip" and not all(map(_byte, said.split(".")))
                or kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits))
                or kind == "phone" and not 10 <= len(digits) <= 15
            ):
                continue
            out.append((start, order, end, kind))
    return [(start, end, kind) for start, _, end, kind in sorted(out)]


def more_spans(text: str, base: list[tuple[int, int, str]], named: bool) -> list[tuple[int, int, str]]:
    """Further candidates, leftmost first, none over a base span or over another candidate."""
    found = []
    for order, (kind, pattern) in enumerate((("number", _NUMBER), ("secret", _SECRET), ("name", _NAME),
                                             ("handle", _HANDLE))):
        if kind != "name" or named:
            found += [(m.start(), order, m.end(), kind) for m in pattern.finditer(text)]
    out, at, k, taken = [], -1, 0, sorted((a, b) for a, b, _ in base)
    for start, _, end, kind in sorted(found):
        while k < len(taken) and taken[k][1] <= start:
            k += 1
        if start >= at and not any(a < end and start < b for a, b in taken[k : k + 4]):
            out.append((start, end, kind))
            at = end
    return out


def votes(text: str, start: int, end: int, kind: str) -> str:
    """One letter for each labeler (y, n or -) and one for the length: form, gazetteer, context, plain use, borders."""
    said = text[start:end]
    digits = sum(c.isdigit() for c in said)
    letters = sum(c.isalpha() for c in said)
    before = [w.lower() for w in _WORD.findall(text, max(0, start - 40), start)][-3:]
    if kind in ("number", "secret"):
        strict = kind == "number" and (luhn("".join(c for c in said if c.isdigit())) and digits >= 12) or (
            kind == "secret" and digits >= 4 and letters >= 4)
    else:
        strict = True
    form = "y" if strict else "n" if kind == "number" and digits < 9 else "-"
    cue = "y" if _CUE_SETS[kind] & set(before) else "n" if kind in ("number", "secret", "handle") else "-"
    near = text[max(0, start - 3) : start]
    context = "y" if re.search(r"[:=\"'<(]\s?$", near) else "-"
    after = text[end : end + 2].lstrip()
    plain = "n" if set(before[-1:]) & _PLAIN or after[:1] in ("%", "€", "$") or near.rstrip()[-1:] in (
        "$", "€", "£", "#") else "-"
    left = start == 0 or not text[start - 1].isalnum()
    right = end == len(text) or not text[end].isalnum()
    border = "y" if left and right else "n"
    size = next(k for k, most in enumerate((6, 9, 12, 16, 24, 1 << 60)) if end - start <= most)
    return form + cue + context + plain + border + str(size)


_PATTERN_SIZE = 3 * LABELERS + len(KINDS + EXTRA) + 6


def _design(keys: list[tuple[str, str]]) -> np.ndarray:
    x = np.zeros((len(keys), _PATTERN_SIZE))
    for row, (kind, said) in enumerate(keys):
        for k, v in enumerate(said[:LABELERS]):
            x[row, 3 * k + "yn-".index(v)] = 1
        x[row, 3 * LABELERS + (KINDS + EXTRA).index(kind)] = 1
        x[row, 3 * LABELERS + len(KINDS + EXTRA) + int(said[LABELERS])] = 1
    return x


def fit(counts: dict[tuple[str, str], int], rounds: int = 200) -> dict[tuple[str, str], float]:
    """The probability that a span with these votes is personal data, for each pattern of votes.

    Expectation-maximisation over two classes with one table of vote probabilities per labeler; abstentions say nothing.
    Base spans passed a validating pattern and count as certain. Its posteriors are the soft labels of a logistic model
    on votes, kind and length, which gives the final probabilities.
    """
    keys = sorted(counts)
    if not keys:
        return {}
    n = np.array([counts[k] for k in keys], float)
    vote = np.array([["yn-".index(v) for v in said[:LABELERS]] for _, said in keys])
    sure = np.array([kind in KINDS for kind, _ in keys])
    post = np.clip(0.5 + 0.25 * ((vote == 0).sum(1) - (vote == 1).sum(1)), 0.05, 0.95)
    post[sure] = 0.99
    for _ in range(rounds):
        prior = ((n * post)[~sure].sum() + 1) / (n[~sure].sum() + 2)
        odds = np.full(len(keys), np.log(prior / (1 - prior)))
        for k in range(LABELERS):
            # Abstentions carry no weight; one imagined right vote of each sort keeps a labeler better than chance.
            yes = [(n * post)[vote[:, k] == v].sum() + (2 if v == 0 else 1) for v in (0, 1)]
            no = [(n * (1 - post))[vote[:, k] == v].sum() + (1 if v == 0 else 2) for v in (0, 1)]
            for v in (0, 1):
                odds[vote[:, k] == v] += np.log(yes[v] / sum(yes)) - np.log(no[v] / sum(no))
        new = np.where(sure, 0.99, 1 / (1 + np.exp(-np.clip(odds, -30, 30))))
        moved = np.abs(new - post).max()
        post = new
        if moved < 1e-9:
            break
    x = _design(keys)
    weight = np.zeros(x.shape[1])
    share = np.sqrt(n)  # a pattern that is seen a million times does not drown the rest
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ weight))
        slope = x.T @ (share * (post - p)) - 0.1 * weight
        bend = (x * (share * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(weight))
        step = np.linalg.solve(bend, slope)
        weight += step
        if np.abs(step).max() < 1e-8:
            break
    return dict(zip(keys, 1 / (1 + np.exp(-x @ weight)), strict=True))


def _rows(batch: pa.RecordBatch, text: str):
    """(row, text, named) of the rows that can hold a candidate: those with a digit, an @ or a given name."""
    said = batch.column(text)
    data, offsets = W.text_buffer(said)
    marks = np.flatnonzero(((data >= 48) & (data <= 57)) | (data == 64))
    rows = set(np.unique(np.searchsorted(offsets, marks, side="right") - 1).tolist())
    named = set(np.flatnonzero(pc.match_substring_regex(said.fill_null(""), _NAMED).to_numpy(zero_copy_only=False)).tolist())
    for row in sorted(rows | named):
        yield row, said[row].as_py(), row in named


def count_votes(docs: DataFrame, text: str = "text") -> dict[tuple[str, str], int]:
    def count(batches):
        seen: Counter = Counter()
        for whole in batches:
            for batch in W.slices(whole, text):
                for _, said, named in _rows(batch, text):
                    base = base_spans(said)
                    for start, end, kind in base + more_spans(said, base, named):
                        seen[kind, votes(said, start, end, kind)] += 1
        keys = list(seen)
        yield pa.RecordBatch.from_pydict({
            "kind": pa.array([k for k, _ in keys], pa.string()), "votes": pa.array([v for _, v in keys], pa.string()),
            "n": pa.array([seen[k] for k in keys], pa.int64())})

    rows = docs.select(F.col(text).cast("string").alias(text))
    found = rows.mapInArrow(count, "kind string, votes string, n long").groupBy("kind", "votes").agg(F.sum("n").alias("n"))
    return {(r["kind"], r["votes"]): r["n"] for r in found.toArrow().to_pylist()}


def find(docs: DataFrame, key: str = "doc_id", text: str = "text", least: float = 0.5) -> DataFrame:
    """(key, spans: array of (kind, start, end, base)) for every row of ``docs``; places count code points.

    Null and empty texts have no spans. Each row is read by itself, so repeated rows have the same spans; other columns
    are not looked at. A very long text is read as a whole, in time that grows with its length, whatever runs it holds.
    """
    model = docs.sparkSession.sparkContext.broadcast({k for k, p in fit(count_votes(docs, text)).items() if p >= least})

    def mark(batches):
        for whole in batches:
            for batch in W.slices(whole, text):
                out = [[] for _ in range(batch.num_rows)]
                for row, said, named in _rows(batch, text):
                    base = base_spans(said)
                    spans = [(s, (KINDS + EXTRA).index(k), e, True) for s, e, k in base]
                    spans += [(s, (KINDS + EXTRA).index(k), e, False) for s, e, k in more_spans(said, base, named)
                              if (k, votes(said, s, e, k)) in model.value]
                    out[row] = [{"kind": (KINDS + EXTRA)[k], "start": s, "end": e, "base": b}
                                for s, k, e, b in sorted(spans)]
                kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                           ("base", pa.bool_())]))
                yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(out, kind)], names=[key, "spans"])

    rows = docs.select(key, F.col(text).cast("string").alias(text))
    own = f"{key} {dict(rows.dtypes)[key]}, spans array<struct<kind:string,start:long,end:long,base:boolean>>"
    return rows.mapInArrow(mark, own)


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text", least: float = 0.5) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets."""
    model = docs.sparkSession.sparkContext.broadcast({k for k, p in fit(count_votes(docs, text)).items() if p >= least})

    def hide(batches):
        for whole in batches:
            for batch in W.slices(whole, text):
                place = batch.schema.names.index(text)
                said = batch.column(place).to_pylist()
                for row, now, named in _rows(batch, text):
                    base = base_spans(now)
                    more = [x for x in more_spans(now, base, named) if (x[2], votes(now, *x)) in model.value]
                    parts, at = [], 0
                    for start, end, kind in sorted(base + more):
                        if start >= at:
                            parts += [now[at:start], f"[{kind}]"]
                        at = max(at, end)
                    said[row] = "".join([*parts, now[at:]])
                columns = list(batch.columns)
                columns[place] = pa.array(said, pa.string())
                yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    rows = docs.withColumn(text, F.col(text).cast("string"))
    return rows.mapInArrow(hide, rows.schema)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(documents(spark, sf_dir).select("doc_id", "text"))

    def written(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))

    def number(kind):
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["base"])
    return found.select("doc_id", *(number(k) for k in KINDS), F.sha2(written(base), 256).alias("base_sha256"),
                        written(F.col("spans")).alias("spans"))
