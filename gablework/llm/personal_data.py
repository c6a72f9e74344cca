"""Personal data in texts: four kinds by pattern, and more spans by a character tagger that learned from them.

The base spans follow fixed patterns. The tagger learns from windows around base spans, their characters partly
rewritten into the forms that people use to write the same thing (a phone number without its plus, an address with blanks or
"(at)" in it, a card number with other separators), and from windows without any. What it finds is added if it
meets the kind's rule (Luhn, parts up to 255, number of digits) and does not touch a base span.

The tagger is fitted on at most ``PER_KIND`` windows of each kind and as many without a span, chosen by hash from all texts.
Whole texts are read. A null text is an empty one; rows with null or repeated ids are rows like others; an empty table
gives no rows; without any base span in the table nothing is added. Other columns, whatever their names, are not read.
Offsets count code points.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gablework.llm import char_tagger
from gablework.llm.batches import covered, keyed_texts, slices, tidy

# Kinds in their order, patterns and limits.
KINDS = ("email", "ip", "card", "phone")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
LARGEST_PART, CARD_DIGITS, PHONE_DIGITS = 255, (14, 19), (10, 15)

# What an added span must look like.
ADDED = (
    re.compile(r"[A-Za-z0-9._%+-]+ ?(?:@|\(at\)|\[at\]| at ) ?[A-Za-z0-9-]+(?: ?(?:\.|\(dot\)|\[dot\]| dot ) ?[A-Za-z0-9-]+)+"),
    re.compile(r"[0-9]{1,3}(?: ?(?:\.|\(\.\)|\[\.\]) ?[0-9]{1,3}){3}"),
    re.compile(r"[0-9](?:[ ._/-]{0,2}[0-9])+"),
    re.compile(r"\+?\(?[0-9][ ()./0-9-]*[0-9]"),
)
TOKEN = (LOCAL + "@", "0123456789.", "0123456789", "0123456789+(")
PER_KIND, STEPS, LENGTH = 600, 300, 96
READ_BYTES, SALTS = 2 << 20, 8
Span = tuple[int, int, int]  # start, kind, end


def luhn(digits: str) -> bool:
    doubled = [d * 2 - 9 * (d > 4) if i % 2 else d for i, d in enumerate(map(int, reversed(digits)))]
    return sum(doubled) % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def holds(kind: int, text: str) -> bool:
    """The rule that a matching text must meet."""
    if kind == 0:
        return True
    digits = digits_of(text)
    if kind == 1:
        return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= LARGEST_PART for p in re.findall("[0-9]+", text))
    low, high = CARD_DIGITS if kind == 2 else PHONE_DIGITS
    return low <= len(digits) <= high and (kind == 3 or luhn(digits))


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of name@domain, in time that grows with the text: a name begins where its characters do."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = free + len(text[free:at].rstrip(LOCAL))
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        free = domain.end() if domain else at + 1
        at = text.find("@", free)


def base_spans(text: str) -> list[Span]:
    """(start, kind, end) in order."""
    out = [(a, 0, b) for a, b in emails(text)]
    for kind, pattern in ((1, IP), (2, CARD), (3, PHONE)):
        out += [(m.start(), kind, m.end()) for m in pattern.finditer(text) if holds(kind, m.group())]
    return sorted(out)


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def added_spans(text: str, base: list[Span], tags: np.ndarray) -> list[Span]:
    """Runs of one tag, stretched to whole tokens, that meet the kind's rule and touch no base span."""
    edges = np.flatnonzero(np.diff(tags, prepend=0, append=0))
    taken = covered(np.array([s for s, _, _ in base], np.int64), np.array([e - s for s, _, e in base], np.int64), len(text)) if len(edges) else None
    out, done = [], 0
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        kind = int(tags[a]) - 1
        if kind < 0:
            continue
        while a > done and text[a - 1] in TOKEN[kind]:
            a -= 1
        while b < len(text) and text[b] in TOKEN[kind]:
            b += 1
        found = ADDED[kind].search(text, max(a, done), b)
        if not found:
            continue
        a, b = found.span()
        inside = text[max(0, a - 1) : a].isalnum() or text[b : b + 1].isalnum()
        if not taken[a:b].any() and not inside and holds(kind, found.group()):
            out.append((a, kind, b))
            done = b
    return out


# Learning

WINDOWS = "kind int, h long, part string, spans array<struct<a:int,k:int,b:int>>"


def windows_of(text: str) -> Iterator[tuple[int, int, str, list[Span]]]:
    """(kind, hash, part, spans): a part of the text around each base span, and one of any place."""
    spans = base_spans(text)
    anywhere = xxhash.xxh32_intdigest(text) % max(1, len(text) - LENGTH)
    for kind, at in [(k, a) for a, k, _ in spans] + [(-1, anywhere)]:
        h = xxhash.xxh64_intdigest(text[at : at + LENGTH], seed=kind + 1)
        start = max(0, at - h % (LENGTH // 2)) if kind >= 0 else at
        part = text[start : start + LENGTH]
        inside = [(max(a - start, 0), k, min(b - start, LENGTH)) for a, k, b in spans if a < start + LENGTH and b > start]
        if kind >= 0 or not inside:
            yield kind, h >> 1, part, inside


def learning_windows(texts: DataFrame, per_kind: int) -> list[tuple[str, list[Span]]]:
    """At most ``per_kind`` different windows of each kind, those with the smallest hashes of all texts."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [w for t in batch.column("text").to_pylist() if t for w in windows_of(t)]
            named = [[{"a": a, "k": k, "b": b} for a, k, b in w[3]] for w in found]
            kind = pa.struct([("a", pa.int32()), ("k", pa.int32()), ("b", pa.int32())])
            yield pa.RecordBatch.from_arrays(
                [pa.array([w[0] for w in found], pa.int32()), pa.array([w[1] for w in found], pa.int64()), pa.array([w[2] for w in found], pa.string()),
                 pa.array(named, pa.list_(kind))], ["kind", "h", "part", "spans"]
            )

    found = texts.mapInArrow(tidy(read), WINDOWS).distinct().withColumn("salt", F.col("h") % SALTS)
    for by in (["kind", "salt"], ["kind"]):  # no kind's windows of all tasks meet in one
        nth = F.row_number().over(Window.partitionBy(*by).orderBy("h", "part"))
        found = found.withColumn("nth", nth).where(F.col("nth") <= per_kind)
    rows = found.collect()  # five kinds
    rows.sort(key=lambda r: (r["kind"], r["h"], r["part"]))
    return [(r["part"], [tuple(s) for s in r["spans"]]) for r in rows]


def rewritten(kind: int, text: str, rng: np.random.Generator) -> str:
    """Another form of the same thing."""

    def one(*choices: str) -> str:
        return choices[int(rng.integers(len(choices)))]

    if kind == 0:
        name, _, domain = text.partition("@")
        dot = one(".", ".", " dot ", "[dot]", "(dot)")
        return name + one(" @ ", "(at)", "[at]", " at ", " (at) ", " [at] ", "@ ", " @") + domain.replace(".", dot)
    if kind == 1:
        return text.replace(".", one("[.]", "(.)", " . ", ". "))
    digits = digits_of(text)
    if kind == 2:
        return one(".", "/", "_", "  ", ". ").join(digits[i : i + 4] for i in range(0, len(digits), 4))
    local, sign = digits[-10:], one(".", "/", "-", " ", "")
    national = one("({}) {}-{}", "({}) {} {}", "{0}{3}{1}{3}{2}", "{0}{3}{1}{3}{2}").format(local[:3], local[3:6], local[6:], sign)
    return one("", "", digits[:-10] + " " if len(digits) > 10 else "", "00" + digits[:-10] + " ") + national


def examples(windows: list[tuple[str, list[Span]]], seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and tags of the windows: as they are, and with their whole spans rewritten."""
    rng = np.random.default_rng(seed)
    codes, tags = [], []
    for part, spans in windows:
        for change in (False, True) if spans else (False,):
            text, tag, at = "", [], 0
            for a, kind, b in sorted(spans):
                if a < at:
                    continue  # within the span before it
                whole = part[a:b]
                if change and a > 0 and b < LENGTH and holds(kind, whole):
                    whole = rewritten(kind, whole, rng)
                text += part[at:a] + whole
                tag += [0] * (a - at) + [kind + 1] * len(whole)
                at = b
            text += part[at:]
            tag += [0] * (len(part) - at)
            x = np.zeros(LENGTH, np.uint8)
            y = np.zeros(LENGTH, np.int8)
            n = min(len(text), LENGTH)
            x[:n], y[:n] = char_tagger.symbols(text)[:n], tag[:n]
            codes.append(x)
            tags.append(y)
    return np.array(codes), np.array(tags)


def learned(docs: DataFrame, per_kind: int = PER_KIND, steps: int = STEPS) -> char_tagger.Model | None:
    """The tagger, or None where there is nothing to learn from."""
    windows = learning_windows(docs.select("text"), per_kind)
    if not any(spans for _, spans in windows):
        return None
    return char_tagger.fit(*examples(windows), tags=len(KINDS) + 1, steps=steps)


ROWS = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_kind: int = PER_KIND, steps: int = STEPS) -> DataFrame:
    """Per document the numbers of base spans by kind, a hash of them, all spans in order, and how many the tagger added."""
    texts = keyed_texts(docs, id_col, text_col)
    model = learned(texts, per_kind, steps)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, READ_BYTES):
            read = [t or "" for t in batch.column("text").to_pylist()]
            codes = [char_tagger.symbols(t) for t in read]
            tags = char_tagger.tagged(model, codes) if model else [np.zeros(len(c), np.int8) for c in codes]
            base = [base_spans(t) for t in read]
            more = [added_spans(t, b, g) for t, b, g in zip(read, base, tags)]
            columns = [pa.array([sum(k == kind for _, k, _ in b) for b in base], pa.int64()) for kind in range(len(KINDS))]
            hashes = [hashlib.sha256(listed(b).encode()).hexdigest() for b in base]
            spans = [listed(sorted(b + m)) for b, m in zip(base, more)]
            columns = [batch.column("doc"), *columns, pa.array(hashes), pa.array(spans), pa.array([len(m) for m in more], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in ROWS.split(", ")])

    return texts.mapInArrow(tidy(read), ROWS)
