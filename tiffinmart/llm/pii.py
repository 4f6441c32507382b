"""Personal data: known patterns, and spans that a bidirectional LSTM with CRF transitions reads from characters."""

from __future__ import annotations

import bisect
import hashlib
import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tiffinmart.llm.char_lstm import KINDS, SpanNet, codes_of, spans_of, tags_of
from tiffinmart.llm.frames import hash_unit, in_blocks, pick

#: What `spans` calls the spans that the network adds.
ADDED = tuple(f"model_{k}" for k in KINDS)

_LOCAL = re.compile("[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile("[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NUMBER, _NO_DIGIT = re.compile("[0-9]+"), re.compile("[^0-9]+")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of the pattern, found from each `@`: a run of local characters has one end only."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.match(text, start - 1):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        done = domain.end() if domain else at + 1
        at = text.find("@", done)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def octets(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in _NUMBER.findall(text))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the pattern matches, in code points, in order; kinds are places in `KINDS`."""
    out = [(0, s, e) for s, e in emails(text)] if "@" in text else []
    if text.count(".") > 2:
        out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if octets(m[0])]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(digits := _NO_DIGIT.sub("", m[0])) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_NO_DIGIT.sub("", m[0])) <= 15]
    return out


_OPEN, _CLOSE = r"\s?[\[({<]\s?", r"\s?[\])}>]\s?"
#: What a span of each kind looks like, apart from its numbers. A bare "at" needs a dot that is spelt out.
FORMS = tuple(
    re.compile(rf"(?<![0-9A-Za-z]){form}(?![0-9A-Za-z])")
    for form in (
        rf"[\w.%+-]+(?:(?: ?@ ?|{_OPEN}(?:@|at|AT){_CLOSE})[\w-]+(?:(?: ?\. ?|{_OPEN}(?:\.|dot|DOT){_CLOSE}| (?:dot|DOT) )[\w-]+)+"
        rf"| (?:at|AT) [\w-]+(?:(?:{_OPEN}(?:\.|dot|DOT){_CLOSE}| (?:dot|DOT) )[\w-]+)+)",
        r"[0-9]{1,3}(?:(?: ?[.,] ?|\[\.\]|\(\.\)| dot )[0-9]{1,3}){3}",
        "[0-9](?:[ ./-]{0,3}[0-9]){12,18}",
        r"[+(]?[0-9](?:[ ()./-]{0,2}[0-9]){8,14}(?![ ()./-]{1,2}[0-9])",
    )
)


_GOES_ON = re.compile(r"[0-9][ ./-]{1,2}\Z")


def formed(kind: int, text: str, start: int, end: int, reach: int = 24) -> tuple[int, int] | None:
    """The string of its kind at what the network read, or None if there is none: the exact part of its judgement."""
    from_ = max(0, start - reach)
    for m in FORMS[kind].finditer(text[from_ : end + reach]):
        s, e = m.start() + from_, m.end() + from_
        if 2 * (min(e, end) - max(s, start)) < end - start or (s == from_ > 0 and text[s - 1].isalnum()) or text[e : e + 1].isalnum():
            continue
        digits = _NO_DIGIT.sub("", m[0])
        if kind == 3 and _GOES_ON.search(text, max(0, s - 3), s):
            continue
        if kind == 0 or kind == 1 and octets(m[0]) or kind == 2 and luhn(digits) or kind == 3 and len(digits) < len(m[0]):
            return s, e
    return None


class Forms:
    """Labelled strings that the patterns miss, made from random numbers and names by rule."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def number(self, n: int) -> str:
        return "".join(self.r.choice("0123456789") for _ in range(n))

    def name(self) -> str:
        return "".join(self.r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(self.r.randint(2, 9)))

    def card(self) -> str:
        body = self.r.choice("3456") + self.number(14)
        return next(body + d for d in "0123456789" if luhn(body + d))

    def plain(self, kind: int) -> str:
        """As the patterns have it."""
        r = self.r
        if kind == 0:
            return f"{self.name()}{r.choice(['', '.', '_'])}{r.choice(['', self.name(), self.number(2)])}@{self.name()}{r.choice(['', self.number(1)])}.{r.choice(['com', 'org', 'net', 'de', 'co.uk'])}"
        if kind == 1:
            return ".".join(str(r.randint(1, 255)) for _ in range(4))
        if kind == 2:
            c = self.card()
            return r.choice(["", " ", "-"]).join(c[i : i + 4] for i in range(0, 16, 4))
        return f"+{r.randint(1, 99)}{r.choice([' ', ' (', '-'])}{self.number(3)}{r.choice([') ', ' ', '-'])}{self.number(3)}{r.choice(['-', ' ', '.'])}{self.number(4)}"

    def hidden(self, kind: int) -> str:
        """As people write it to be read, or not to be found."""
        r = self.r
        if kind == 0:
            at = r.choice([" at ", " [at] ", "(at)", " @ ", "[at]", " AT "])
            dot = r.choice([" dot ", " [dot] ", "(dot)", "[dot]"]) if at != " @ " else r.choice([".", " . "])
            return f"{self.name()}{r.choice(['', '.', '_'])}{r.choice(['', self.name()])}".rstrip("._") + f"{at}{self.name()}{dot}{r.choice(['com', 'org', 'net', 'de'])}"
        if kind == 1:
            return r.choice([" . ", "[.]", "(.)", " dot ", ". "]).join(str(r.randint(1, 255)) for _ in range(4))
        if kind == 2:
            c = self.card()
            return r.choice([".", " - ", "/", "  "]).join(c[i : i + 4] for i in range(0, 16, 4))
        a, b, c = self.number(3), self.number(3), self.number(4)
        return r.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"({a}) {b} {c}", f"0{a}/{b}{c}", f"00{r.randint(1, 99)} {a} {b} {c}"])

    def decoy(self) -> str:
        """Numbers and names that are none of these."""
        r = self.r
        return r.choice(
            [
                self.number(r.randint(1, 8)), self.number(r.randint(16, 24)), f"{r.randint(1990, 2030)}-{r.randint(10, 12)}-{r.randint(10, 28)}",
                f"{r.randint(1, 9)}.{r.randint(0, 99)}.{r.randint(0, 99)}", f"{r.randint(10, 23)}:{r.randint(10, 59)}:{r.randint(10, 59)}", f"@{self.name()}",
                f"{r.randint(1, 999)},{self.number(3)}.{self.number(2)}", f"{self.name()}.{self.name()}", f"{self.name()} at {self.name()}", f"(at {self.name()})",
                "".join(r.choice("0123456789abcdef") for _ in range(r.randint(16, 40))), f"{self.name()}_{self.number(3)}", f"{self.number(4)}/{self.number(2)}", f"{self.number(4)} {self.number(4)}",
            ]
        )


def labelled_windows(samples: list[tuple[str, list]], per_kind: int, length: int, seed: int) -> tuple[list[str], list[np.ndarray]]:
    """Windows of text and a tag per character: the sampled windows with their pattern spans, and as many again for
    each kind into which plain and hidden forms, and decoys, are written."""
    forms, texts, tags = Forms(seed), [], []
    for text, spans in samples:
        texts.append(text)
        tags.append(tags_of(len(text), spans))
    bare = [t for t, spans in samples if not spans] or [t for t, _ in samples] or ["and so on, "]
    for kind in (*range(len(KINDS)), -1):
        for i in range(per_kind):
            text = forms.r.choice(bare)
            own = forms.decoy() if kind < 0 else forms.plain(kind) if i % 3 == 0 else forms.hidden(kind)
            cut = forms.r.randint(0, len(text))
            while 0 < cut < len(text) and not text[cut].isspace():
                cut -= 1
            head = text[:cut].rstrip()[-forms.r.randint(0, length) :] + forms.r.choice([" ", " ", ": ", "\n", " ("])
            whole = head + own + forms.r.choice([" ", ". ", ", ", "\n", "; "]) + text[cut:].lstrip()
            from_ = max(0, min(len(head) - forms.r.randint(0, length // 2), len(head) + len(own) + 4 - length))
            whole, start = whole[from_ : from_ + length], len(head) - from_
            texts.append(whole)
            tags.append(tags_of(len(whole), [] if kind < 0 else [(kind, start, min(start + len(own), length))]))
    return texts, tags


def training_samples(docs: DataFrame, most_docs: int, per_kind: int, length: int) -> list[tuple[str, list]]:
    """Windows of `length` characters with the pattern spans in them, from about `most_docs` documents chosen by the
    hash of their id: at most `per_kind` around spans of each kind, and as many without. Nothing else is collected."""
    share = min(1.0, most_docs / max(docs.count(), 1))
    some = docs.filter(hash_unit(F.lit("spans"), F.col("doc_id")) < int(share * (1 << 52)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value in batch.column("text"):
                text = value.as_py() or ""
                spans = base_spans(text)
                key = hashlib.sha256(text.encode("utf-8", "replace")).hexdigest()
                r = random.Random(key)
                for n, (kind, s, e) in enumerate(spans[: 2 * per_kind]):
                    a = max(0, s - r.randint(0, length // 2))
                    if e <= a + length:
                        inside = [(k, x - a, min(y, a + length) - a) for k, x, y in spans if x >= a and x < a + length]
                        rows.append((kind, f"{key}{n}", text[a : a + length], ",".join(f"{k}:{x}:{y}" for k, x, y in inside)))
                a = r.randint(0, len(text))
                if len(text) and not any(x < a + length and y > a for _, x, y in spans):
                    rows.append((-1, key, text[a : a + length], ""))
            kinds, keys, texts, told = zip(*rows, strict=True) if rows else ((), (), (), ())
            columns = [pa.array(kinds, pa.int32()), pa.array(keys, pa.string()), pa.array(texts, pa.string()), pa.array(told, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["kind", "key", "text", "spans"])

    rows = some.mapInArrow(cut, "kind int, key string, text string, spans string")
    place = F.row_number().over(Window.partitionBy("kind").orderBy("key"))
    found = rows.withColumn("place", place).filter(F.col("place") <= per_kind).orderBy("kind", "key").collect()
    return [(r["text"], [tuple(map(int, s.split(":"))) for s in r["spans"].split(",") if s]) for r in found]


def learned(docs: DataFrame, most_docs: int, per_kind: int, length: int, seed: int) -> SpanNet:
    """A network that has learnt from `docs`; one that has not, where there is no text."""
    samples = training_samples(docs, most_docs, per_kind, length)
    return SpanNet().fit(*labelled_windows(samples, per_kind, length, seed), length) if samples else SpanNet()


def added_spans(text: str, tags: np.ndarray, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """What the network read, moved to the ends of a string of its kind, where it touches no span before it."""
    out: list[tuple[int, int, int]] = []
    taken = sorted((s, e) for _, s, e in base)
    for kind, start, end in spans_of(tags):
        near = bisect.bisect_left(taken, (start, end))
        if any(s <= start and end <= e for s, e in taken[max(0, near - 2) : near + 1]):
            continue
        # Groups of digits are of the kind whose numbers they have, if not of the one that was read.
        others = [k for k in (1, 2, 3) if k != kind] if kind else []
        kind, whole = next(((k, w) for k in (kind, *others) if (w := formed(k, text, start, end))), (kind, None))
        if whole and not any(s < whole[1] and whole[0] < e for s, e in taken):
            out.append((kind, *whole))
            bisect.insort(taken, whole)
    return out


def told(spans: list[tuple[int, int, int]], names: tuple[str, ...]) -> list[str]:
    return [f"{names[k]}:{s}:{e}" for k, s, e in sorted(spans)]


def find_personal(docs: DataFrame, most_docs: int = 20_000, per_kind: int = 300, length: int = 96, window: int = 320, margin: int = 20, seed: int = 5) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans and n_model of every row of `docs`.

    Pattern spans come first: e-mail addresses, IP addresses, card numbers that pass Luhn's test, phone numbers with a
    plus. A network over characters adds `model_` spans of these kinds: windows of `window` characters cover the whole
    text, overlap by twice the `margin`, and are decoded under tag transitions; what it reads is kept where it touches
    no pattern span and has the numbers of its kind. It learns from at most `per_kind` windows around pattern spans of
    each kind and as many without any, from about `most_docs` documents chosen by the hash of their id, and from forms
    that the patterns miss, written into such windows by rule. `spans` are `kind:start:end` by kind and start, in code
    points with exclusive end; the counts and the digest are those of the pattern spans. A null or empty text has no
    spans (the digest is that of the empty string); a null id is hashed as empty; repeated rows each get a row; no
    documents give no rows; other columns are not read.
    """
    picked = pick(docs, "doc_id", "text")
    return scanned(picked, learned(picked, most_docs, per_kind, length, seed), window, margin)


def scanned(docs: DataFrame, net: SpanNet, window: int = 320, margin: int = 20) -> DataFrame:
    """What `find_personal` gives, with a network that has learnt already."""
    picked, weights = pick(docs, "doc_id", "text"), net.p

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = SpanNet()
        own.p = weights
        for batch in in_blocks(batches, 2 << 20):
            texts = [v or "" for v in batch.column("text").to_pylist()]
            base = [base_spans(t) for t in texts]
            tags = own.tags([codes_of(t) for t in texts], window, margin)
            more = [added_spans(t, g, b) if g.any() else [] for t, g, b in zip(texts, tags, base, strict=True)]
            digest = [hashlib.sha256(",".join(told(b, KINDS)).encode()).hexdigest() for b in base]
            spans = [",".join(told(b, KINDS) + told(m, ADDED)) for b, m in zip(base, more, strict=True)]
            count = [[sum(k == kind for k, _, _ in b) for b in base] for kind in range(len(KINDS))]
            columns = [*[pa.array(c, pa.int64()) for c in count], pa.array(digest, pa.string()), pa.array(spans, pa.string()), pa.array([len(m) for m in more], pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_model"])

    kind = picked.schema["doc_id"].dataType.simpleString()
    return picked.mapInArrow(scan, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_model long")
