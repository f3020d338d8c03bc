"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import read_table

from .base import map_batches

KINDS = ("email", "ip", "card", "phone")          # base kinds, in the order of the digest
EXTRA = ("iban", "ssn", "secret")                 # kinds the method adds
MIN_SCORE = 0.6
CONTEXT = 40                                       # characters looked at on each side of a proposal
PART_ROWS = 500                                    # texts searched at once: bounds a worker's memory

# Each pattern starts at the first character of its run (look-behind) and runs on without
# giving back (possessive), so a long run is read once and matches are the leftmost ones.
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
SECRET = re.compile(r"(?i)(?<![A-Za-z0-9])(?:password|passwd|token|secret|api_?key)\x20{0,2}[=:]\x20{0,2}\"?"
                    r"([A-Za-z0-9+/_-]{12,})")

#: score of a proposal before context, and the words near it that raise or lower it
PRIOR = {"iban": 0.7, "ssn": 0.5, "secret": 0.5}
RAISE = {"iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
         "ssn": ("ssn", "social", "security"),
         "secret": ("password", "passwd", "token", "secret", "key")}
LOWER = ("example", "isbn", "order", "invoice", "version")
DIGITS = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """The check of an IBAN: country and check digits moved behind, letters as numbers, rest 1."""
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def iban_end(text: str, start: int, end: int) -> int:
    """Where a proposed IBAN ends: the longest run of its groups that ends a word and passes
    mod 97, or -1.  The proposal may run into the words behind, or stop inside one."""
    if text[end:end + 1].isalnum() and text[end].isascii():
        end = text.rfind(" ", start, end)
    while end > start:
        word = text[start:end].replace(" ", "")
        if 15 <= len(word) <= 34 and mod97(word):
            return end
        end = text.rfind(" ", start, end)
    return -1


def ibans(text: str) -> list:
    """Leftmost non-overlapping IBANs: the search goes on behind a confirmed one, and at the
    next word of a proposal that is none."""
    out, m = [], IBAN.search(text)
    while m:
        end = iban_end(text, m.start(), m.end())
        if end > 0:
            out.append((m.start(), end))
        m = IBAN.search(text, end if end > 0 else m.start() + 1)
    return out


def emails(text: str) -> list:
    """Leftmost non-overlapping emails, found from their at signs: the part before one is the
    longest run of local characters that the previous match leaves."""
    out, end, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    return out


def base_spans(text: str) -> dict:
    """kind -> spans of the four base kinds."""
    out = {k: [] for k in KINDS}
    if "@" in text:
        out["email"] = emails(text)
    if DIGITS.search(text):
        for m in IP.finditer(text):
            parts = [p.lstrip("0") for p in m.group().split(".")]
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                out["ip"].append(m.span())
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 16:
                digits = m.group().replace(" ", "").replace("-", "")
                if 16 <= len(digits) <= 19 and luhn(digits):
                    out["card"].append(m.span())
        if "+" in text:
            for m in PHONE.finditer(text):
                if 8 <= len(DIGITS.findall(m.group())) <= 15:
                    out["phone"].append(m.span())
    return out


def context_score(text: str, kind: str, start: int, end: int) -> float:
    near = (text[max(0, start - CONTEXT):start] + " " + text[end:end + CONTEXT]).lower()
    words = set(re.findall("[a-z]+", near))
    score = PRIOR[kind] + 0.3 * bool(words & set(RAISE[kind])) - 0.3 * bool(words & set(LOWER))
    return max(0.0, min(1.0, score))


def added_spans(text: str, base: dict, min_score: float = MIN_SCORE) -> list:
    """(kind, start, end) of the added kinds: confirmed by checksum or format, scored by
    context, and not overlapping a base span."""
    taken, out = sorted(s for spans in base.values() for s in spans), []
    if not DIGITS.search(text):
        return out
    proposed = (("iban", ibans(text)), ("ssn", [m.span() for m in SSN.finditer(text)]),
                ("secret", [m.span(1) for m in SECRET.finditer(text)]))
    for kind, spans in proposed:
        for start, end in spans:
            word = text[start:end].replace(" ", "")
            if kind == "ssn" and (word[:3] in ("000", "666") or word[0] == "9" or word[4:6] == "00" or word[7:] == "0000"):
                continue
            if kind == "secret" and not (DIGITS.search(word) and re.search("[A-Za-z]", word)):
                continue
            if context_score(text, kind, start, end) >= min_score and not any(a < end and start < b for a, b in taken):
                out.append((kind, start, end))
    return out


def spans_of(text: str | None) -> list:
    """All (kind, start, end) of a text in code points: base kinds as listed, then added ones."""
    text = text or ""
    base = base_spans(text)
    return [(k, a, b) for k in KINDS for a, b in base[k]] + added_spans(text, base)


def find(docs: DataFrame, carry: tuple = ("doc_id",)) -> DataFrame:
    """The ``carry`` columns and ``found``: an array of (kind, start, end) for every row.

    Null and empty texts have none.  Whole texts are searched; time is linear in their
    length.  Rows are independent, so repeated rows repeat their spans."""
    fields = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join(f"`{c}` {fields[c]}" for c in carry) + \
        ", found array<struct<kind: string, start: bigint, end: bigint>>"

    def run(batch):
        out = {c: batch.column(c) for c in carry}
        out["found"] = [[{"kind": k, "start": a, "end": b} for k, a, b in spans_of(t.as_py())]
                        for t in batch.column("text")]
        return out

    return map_batches(docs.select(*dict.fromkeys((*carry, "text"))), schema, run, rows=PART_ROWS)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; n_chars, if there, follows.

    Overlapping spans become one mark, that of the first."""
    names = [c for c in docs.columns]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)

    def one(text):
        if not text:
            return text
        parts, end = [], 0
        for a, b, k in sorted((a, b, k) for k, a, b in spans_of(text)):
            if a >= end:
                parts += [text[end:a], f"[{k.upper()}]"]
            end = max(end, b)
        return "".join(parts) + text[end:] if parts else text

    def run(batch):
        out = {c: batch.column(c) for c in names}
        out["text"] = [one(t.as_py()) for t in batch.column("text")]
        if "n_chars" in names:
            out["n_chars"] = [n.as_py() if t is None else len(t) for n, t in zip(batch.column("n_chars"), out["text"])]
        return out

    return map_batches(docs, schema, run, rows=PART_ROWS)


def digest(spans: list) -> tuple:
    base = ",".join(f"{k}:{a}:{b}" for k, a, b in spans if k in KINDS)
    return hashlib.sha256(base.encode()).hexdigest(), ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    mark = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    base = F.filter("found", lambda s: s["kind"].isin(*KINDS))
    number = lambda k: F.size(F.filter("found", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return found.select("doc_id", *map(number, KINDS),
                        F.sha2(F.array_join(F.transform(base, mark), ",").cast("binary"), 256).alias("base_sha256"),
                        F.array_join(F.transform("found", mark), ",").alias("spans"))
