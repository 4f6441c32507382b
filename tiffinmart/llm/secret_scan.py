"""Secret scan: known patterns, and strings in a sensitive context that a primed compressor cannot shorten."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tiffinmart.llm.frames import pick

#: Order of kinds among spans with one start.
KINDS = ("assign", "access", "hex", "novel")
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

# A text of common identifiers and code idioms, what a compressor should find unsurprising.
IDENTIFIERS = """
abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 0123456789abcdef 1234567890 00000000 ffffffff xxxxxxxx
api_key apiKey access_key accessKey access_token accessToken refresh_token auth_token authorization Authorization: Bearer Basic
client_id client_secret clientSecret secret_key secretKey private_key privateKey public_key password passwd passphrase
credential credentials session_id sessionId cookie signature username user_name hostname localhost 127.0.0.1 https:// http:// www. .com
example placeholder changeme your_password your_api_key your_token_here insert_key_here environment variable os.environ getenv
process.env config.get settings.json application.properties resources database connection string jdbc:mysql:// postgresql://
import from return function def class self this null None true false undefined const static final public private protected
int long string String boolean float double void list dict map set array length size index value key name type id
getElementById addEventListener toString valueOf hashCode equals compareTo iterator next hasNext append insert update delete select
"""

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile("AKIA[A-Z0-9]+")
_HEX = re.compile("[0-9a-f]{16,}")  # a run of at least 16 is a whole run of [0-9a-f]+
_LONG = re.compile("[A-Za-z0-9+/_~.-]+(?:={1,2}(?![A-Za-z0-9+/_=~.-]))?")  # "=" only as padding, else it ends a name
_GIVEN = re.compile(r"""[:=]["']?\x20*["']?$""")
_DIGIT, _LETTER = re.compile("[0-9]"), re.compile("[A-Za-z]")
_CONTEXT = re.compile(r"key|secret|token|passw|pwd|credential|auth|bearer|private|signature|session|cookie", re.I | re.A)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the pattern matches, in code points; kinds are places in `KINDS`."""
    out = []
    low = text.lower()
    if any(w in low for w in WORDS):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


class Novelty:
    """Marginal compressed size of a string behind its context, with identifiers as the compressor's dictionary."""

    def __init__(self, level: int = 9):
        import zstandard

        primed = zstandard.ZstdCompressionDict(IDENTIFIERS.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.size = lambda data: len(compressor.compress(data))
        compressor = zstandard.ZstdCompressor(level=level, dict_data=primed, write_content_size=False, write_checksum=False)

    def per_byte(self, candidate: str, context: str) -> float:
        around, own = context.encode("utf-8", "replace"), candidate.encode("utf-8", "replace")
        return (self.size(around + own) - self.size(around)) / len(own)


def apart(start: int, end: int, taken: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """What is left of start to end outside of the spans, which are in order of their starts."""
    for s, _, e in taken:
        if start < s < end:
            yield start, s
        if s < end:
            start = max(start, e)
    if start < end:
        yield start, end


def novel_spans(text: str, taken: list[tuple[int, int, int]], novelty: Novelty, least: float, reach: int) -> list[tuple[int, int, int]]:
    """Strings of 16 and more characters after a sensitive word, or what the spans already found leave of them, that
    cost `least` compressed bytes per byte or more. They have letters and digits, or letters alone where they are
    given a name: to a compressor any rare word of a prose is as new as a secret."""
    out = []
    for m in _LONG.finditer(text):
        if m.end() - m.start() < 16:
            continue
        for start, end in apart(m.start(), m.end(), taken):
            own, before = text[start:end], text[max(0, start - reach) : start]
            if end - start < 16 or not _LETTER.search(own) or not _CONTEXT.search(before):
                continue
            given = _GIVEN.search(before) and not own.startswith("//")
            if (given or _DIGIT.search(own)) and novelty.per_byte(own, before + text[end : end + reach]) >= least:
                out.append((start, 3, end))
    return out


def told(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))


def scan_secrets(docs: DataFrame, least: float = 0.6, reach: int = 48) -> DataFrame:
    """One row per row of `docs`: counts by kind, a digest of the pattern spans, and all spans as text.

    Spans are `kind:start:end` in code points with exclusive end, by start and then kind. Patterns: assignments to a
    secret's name, access key ids, long hex strings. Beyond them a string of 16 or more characters within `reach`
    characters after a sensitive word, the name it is given to among them, is reported as `novel` when a compressor that knows common identifiers and the
    text around it still needs `least` bytes per byte. A null or empty text has no spans (the digest is that of the
    empty string); repeated rows each get a row; other columns are not read.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty()
        for batch in batches:
            found = []
            for value in batch.column("text"):
                text = value.as_py() or ""
                base = base_spans(text)
                found.append((base, novel_spans(text, base, novelty, least, reach)))
            count = [[sum(k == kind for _, k, _ in base + more) for base, more in found] for kind in range(4)]
            digest = [hashlib.sha256(told(base).encode()).hexdigest() for base, _ in found]
            columns = [pa.array(c, pa.int64()) for c in count]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns[:3], pa.array(digest, pa.string()), pa.array([told(b + m) for b, m in found], pa.string()), columns[3]],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_novel"],
            )

    picked = pick(docs, "doc_id", "text")
    kind = picked.schema["doc_id"].dataType.simpleString()
    return picked.mapInArrow(scan, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_novel long")


def redacted(text: str, spans: list[tuple[int, int, int]], mark: str = "[REDACTED]") -> str:
    out, at = [], 0
    for start, _, end in sorted(spans):
        if end > at:
            if start >= at:
                out += [text[at:start], mark]
            at = end
    return "".join([*out, text[at:]])


def redact_secrets(docs: DataFrame, least: float = 0.6, reach: int = 48) -> DataFrame:
    """`docs` with every span of `scan_secrets` replaced by a mark, overlapping ones by one, and `n_chars` counted anew
    where the text changed. Rows without secrets, null texts among them, come back as they are."""
    names = list(docs.columns)
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    text_at, chars_at = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        novelty = Novelty()
        for batch in batches:
            texts = batch.column(text_at).to_pylist()
            chars = batch.column(chars_at).to_pylist() if chars_at is not None else []
            for i, text in enumerate(texts):
                if text and (spans := base_spans(text)) + (more := novel_spans(text, spans, novelty, least, reach)):
                    texts[i] = redacted(text, spans + more)
                    if chars_at is not None:
                        chars[i] = len(texts[i])
            columns = list(batch.columns)
            columns[text_at] = pa.array(texts, columns[text_at].type)
            if chars_at is not None:
                columns[chars_at] = pa.array(chars, columns[chars_at].type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return plain.mapInArrow(redact, plain.schema).toDF(*names)
