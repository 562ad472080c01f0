"""Secret scans: fixed patterns, and strings near a sensitive word that do not compress.

The patterns are the base. Beyond them, a candidate is a long string that follows a sensitive word
closely. zstandard, primed with a dictionary of identifiers and with the text around the candidate,
compresses the surroundings alone and with the candidate; the difference is what the candidate adds.
Identifiers, paths and repeated words add little. A string that adds almost its full length is noise
to the compressor, and noise next to a word such as `credential` is reported.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadkit.llm.common import bounded_batches, texts

# The kinds in their order, the patterns, and the least lengths.
KINDS = ("assign", "access", "hex", "novel")
ASSIGN = rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)"""
ASSIGN_WORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ACCESS = rb"AKIA[A-Z0-9]+"
HEX = rb"[0-9a-f]{32,}"
LEAST_ASSIGN, LEAST_ACCESS = 8, 16

#: Words that make what follows them sensitive, beyond those of the base patterns.
SENSITIVE = rb"pass[-_ ]?(?:word|wd|phrase|code)|pwd|secret|token|(?:api|access|private)[-_ ]?key|credential|bearer|signature|authorization"
SENSITIVE_WORDS = (
    b"pass", b"pwd", b"secret", b"token", b"key", b"credential", b"bearer", b"signature", b"authorization",
)
#: A candidate: at least so long, and starting in the statement of its word, or so close behind the
#: word if the statement is shorter, on its line or later ones.
LEAST = 16
CANDIDATE = rb"[A-Za-z0-9+/_=-]{%d,}" % LEAST
REACH = 64
#: What ends a statement: a line's end, a semicolon, or the end of a sentence.
STATEMENT_END = rb"[\n\r;]|[.!?]\x20"
#: The lines around a private key, in lower case. What is between them is measured, however long it is.
KEY_BEGIN, KEY_END = rb"-----begin [a-z0-9 ]*private key(?: block)?-----", rb"-----(end|begin)\x20"
#: Bytes of text on either side that the compressor sees as well.
AROUND = 1_024
#: The least share of its own length that a reported candidate adds, for long ones; what shorter ones
#: must add more falls with their length.
NOVEL, NOVEL_SHORT = 0.68, 0.8
LEVEL = 3

#: What identifiers, paths and values in code are made of.
IDENTIFIERS = b" ".join(
    b"""abstract access account action address admin algorithm application argument array assert async
    attribute authentication authorization available await backend background base64 batch boolean
    bucket buffer builder button callback catalog certificate channel character checkpoint checksum
    class client cluster collection column command commit component compression config configuration
    connection constant constructor container content context controller converter cookie counter
    create credential current customer dashboard database dataset datetime decode default delete
    dependency description deserialize destination development directory dispatch document download
    driver duration dynamic element enable encode encryption endpoint engine entity environment error
    event example exception execute executor expected expiration export extension external factory
    failure feature field filename filter folder format framework function gateway generate global
    handler hardware header helper history hostname identifier implement import index information
    initialize input instance integer interface internal invalid iterator javascript keyboard keyword
    language latency library listener location logger machine manager mapping maximum memory message
    metadata method middleware migration minimum module monitor namespace network notification number
    object offset operation operator optional options output override package parameter parent parser
    partition password pattern payload permission pipeline platform plugin policy position prefix
    previous primary private process processor producer production profile project property protected
    protocol provider public publish query random reader receiver record recursive reference register
    registry release remote replace replica repository request require resource response result return
    rollback router runtime sample schedule schema scope script secret security select sequence serial
    serialize server service session settings shared signature snapshot socket source standard static
    status storage stream string struct subscription suffix summary support switch synchronize system
    table target template temporary terminal testing thread threshold timeout timestamp token topic
    transaction transform transport trigger unsigned update upload validate validation value variable
    vector version virtual volume warehouse warning websocket window worker workspace wrapper writer
    abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ 0123456789 0123456789abcdef
    http://www.example.com/ https://api. /usr/local/lib/ /etc/ssl/private/ /home/user/ project/main 00000000 11111111 ffffffff""".split()
    + [b"%d-%02d-%02d" % (year, month, 1) for year in range(2015, 2031) for month in range(1, 13)]
)

#: Letters as frequent as in English, a few digits and capitals, in no order. They stand before what is
#: compressed, so that literals are coded by frequency also where the text around a candidate is short.
LETTERS = b"etaoinsrhldcumfpgwybvkxjqz", b"0123456789", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_ORDER = random.Random(17)
PRIMER = bytes(
    _ORDER.choices(
        b"".join(LETTERS),
        [12, 9, 8, 7.5, 7, 7, 6.3, 6, 6, 4, 4, 3, 3, 2.5, 2.3, 2, 2, 2, 2, 1.5, 1, 0.8, 0.3, 0.3, 0.2, 0.2]
        + [0.1] * 10
        + [0.05] * 26,
        k=512,
    )
)

_ASSIGN = re.compile(ASSIGN)
_ACCESS, _HEX = re.compile(ACCESS), re.compile(HEX)
_SENSITIVE = re.compile(rb"(?:" + SENSITIVE + rb")")
_CANDIDATE = re.compile(CANDIDATE)
_STATEMENT_END = re.compile(STATEMENT_END)
_CASE = re.compile(rb"(?<=[a-z0-9])(?=[A-Z])")
_KEY_BEGIN, _KEY_END = re.compile(KEY_BEGIN), re.compile(KEY_END)

Span = tuple[str, int, int, float]


def base_spans(data: bytes, low: bytes) -> list[Span]:
    """Spans of the fixed patterns in bytes; `low` is the text with A-Z in lower case."""
    found: list[Span] = []
    if any(word in low for word in ASSIGN_WORDS):
        # On the lower-cased text the pattern is that of letters in either case.
        found += [
            ("assign", m.start(), m.end(), 1.0)
            for m in _ASSIGN.finditer(low)
            if m.end(2) - m.start(2) >= LEAST_ASSIGN
        ]
    if b"AKIA" in data:
        found += [
            ("access", m.start(), m.end(), 1.0)
            for m in _ACCESS.finditer(data)
            if m.end() - m.start() >= LEAST_ACCESS
        ]
    found += [("hex", m.start(), m.end(), 1.0) for m in _HEX.finditer(data)]
    return found


def without(data: bytes, start: int, end: int, value: bytes, first: int, last: int) -> bytes:
    """A stretch of bytes without copies of `value` that stand between `first` and `last`, nor parts of them."""
    parts, at = [], start
    copy = data.find(value, max(first, start - len(value) + 1), last)
    while 0 <= copy < end:
        parts.append(data[at : max(at, copy)])
        at = min(end, copy + len(value))
        copy = data.find(value, copy + len(value), last)
    return b"".join(parts) + data[at:end]


def novelty(
    data: bytes,
    start: int,
    end: int,
    compressor: zstandard.ZstdCompressor,
    own: tuple[int, int] | None = None,
) -> float:
    """The bytes that a candidate adds to the compressed text around it, as a share of its length.

    Other copies of the candidate do not count as text around it: a secret that is set and used close
    by is as new at either place. Nor does it matter what a copy is assigned to. `own` is the stretch
    of a longer secret that the candidate is a part of; the rest of it is no text around it either.
    A candidate is measured as it is and as words in lower case, cut where the case rises; the lesser
    counts, so that a name in camel case is as well known as its words.
    """
    value = max(data[start:end].split(b"="), key=len).strip(b"+/_-")
    if 2 * len(value) < end - start:
        value = data[start:end]
    low, high = own or (start, end)
    before = PRIMER + without(data, max(0, low - AROUND), low, value, 0, low)
    after = without(data, high, min(len(data), high + AROUND), value, high, len(data))
    alone = len(compressor.compress(before + after))
    own = data[start:end]
    added = len(compressor.compress(before + after + own)) - alone
    if _CASE.search(own):
        words = _CASE.sub(b" ", own).lower()
        added = min(added, len(compressor.compress(before + after + words)) - alone)
    return added / (end - start)


def least_novelty(length: int) -> float:
    """The least share that a candidate of so many bytes must add."""
    return NOVEL + NOVEL_SHORT / length


def windows(data: bytes, low: bytes) -> Iterator[tuple[int, int]]:
    """Where candidates may start: behind each sensitive word, to its statement's end or the next word."""
    statement, begun = 0, None
    for word in _SENSITIVE.finditer(low):
        if begun is not None:
            yield begun, min(stop, word.start())
        begun = word.end()
        if begun > statement:
            ends = _STATEMENT_END.search(data, begun)
            statement = ends.start() if ends else len(data)
        stop = min(len(data), max(statement, begun + REACH))
    if begun is not None:
        yield begun, stop


def candidates(data: bytes, at: int, stop: int) -> Iterator[tuple[int, int]]:
    """Candidates that start in a stretch of bytes; only the last one, with the parts that dots join to
    it, is read beyond it."""
    while at < stop and (found := _CANDIDATE.search(data, at, stop + LEAST - 1)):
        part = _CANDIDATE.match(data, found.start())
        while part:
            at = part.end()
            yield part.span()
            part = _CANDIDATE.match(data, at + 1) if data[at : at + 1] == b"." else None


def key_spans(data: bytes, low: bytes, claimed: bytearray, compressor: zstandard.ZstdCompressor) -> list[Span]:
    """Private keys between their lines, each a span from its first character to its last.

    A key counts if its lines, each measured without the others, add enough of their length. Without
    its last line, a key has a span for each string that adds enough, to the next such block at most.
    """
    found: list[Span] = []
    for begin in _KEY_BEGIN.finditer(low):
        end = _KEY_END.search(low, begin.end())
        own = begin.end(), end.start() if end else len(data)
        lines = [(s, min(e, own[1])) for s, e in candidates(data, *own)]
        spans = [("novel", s, e, novelty(data, s, e, compressor, own)) for s, e in lines]
        body = data[slice(*own)]
        start, last = own[1] - len(body.lstrip()), own[0] + len(body.rstrip())
        size = sum(e - s for s, e in lines)
        if end and end.group(1) == b"end" and 2 * size >= last - start > 0:
            spans = [("novel", start, last, sum(x * (e - s) for _, s, e, x in spans) / size)]
        for span in spans:
            _, s, e, share = span
            if share >= NOVEL and claimed.find(1, s, e) < 0:
                found.append(span)
                claimed[s:e] = b"\1" * (e - s)
    return found


def novel_spans(
    data: bytes, low: bytes, taken: list[Span], compressor: zstandard.ZstdCompressor
) -> list[Span]:
    """Incompressible strings behind a sensitive word that no base span overlaps."""
    if not any(word in low for word in SENSITIVE_WORDS):
        return []
    claimed = bytearray(len(data))  # bytes of spans
    for _, start, end, _ in taken:
        claimed[start:end] = b"\1" * (end - start)
    found = key_spans(data, low, claimed, compressor)
    measured: set[int] = set()
    for first, stop in windows(data, low):
        for start, end in candidates(data, first, stop):
            if start in measured or claimed.find(1, start, end) >= 0:
                continue
            measured.add(start)
            share = novelty(data, start, end, compressor)
            if share >= least_novelty(end - start):
                found.append(("novel", start, end, share))
                claimed[start:end] = b"\1" * (end - start)
    return found


def find_secrets(text: str | None, compressor: zstandard.ZstdCompressor) -> list[dict]:
    """All spans of a text in code points, by start, then kind."""
    data = (text or "").encode()
    low = data.lower()  # changes A-Z only, so offsets stay
    spans = base_spans(data, low)
    spans += novel_spans(data, low, spans, compressor)
    spans.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    rows, at, points = [], 0, 0
    for kind, start, end, share in spans:
        points += len(data[at:start].decode())
        at = start
        value = data[start:end].decode()
        rows.append(
            {"kind": kind, "start": points, "end": points + len(value), "value": value, "share": share}
        )
    return rows


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of `docs`: doc_id and `spans`, an array of (kind, start, end, value, share).

    Positions count code points, the end is exclusive. Null and empty texts have no spans. Spans of
    one kind do not overlap; the same place may carry several base kinds. Rows repeated give the same
    spans each. `share` is the novelty of a `novel` span and 1 for the others.
    """
    kind = "array<struct<kind:string,start:long,end:long,value:string,share:double>>"

    @F.pandas_udf(kind)
    def spans(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        primed = zstandard.ZstdCompressionDict(IDENTIFIERS, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        primed.precompute_compress(level=LEVEL)
        compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=primed)
        for batch in batches:
            yield pd.Series([find_secrets(text, compressor) for text in batch], dtype=object)

    bounded_batches(docs.sparkSession)
    return texts(docs, id_col, text_col).select("doc_id", spans("text").alias("spans"))


def secret_digest(found: DataFrame) -> DataFrame:
    """Counts by kind, the hash of the base spans and all spans as text, from `scan_secrets`."""
    told = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    base = F.filter("spans", lambda s: s["kind"] != "novel")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(F.concat_ws(",", F.transform(base, told)), 256).alias("base_sha256"),
        F.concat_ws(",", F.transform("spans", told)).alias("spans"),
        count("novel").alias("n_novel"),
    )
