"""Secret scans: fixed forms, and strings that a primed compressor finds new.

Three fixed forms are always reported. Beyond them, a string of 16 characters or more is a candidate if a
sensitive word stands on its line, anywhere before or behind it, or on the line above or below, blank lines
not counted. A private key between PEM marks is one candidate over all its lines, short last line included.
zstandard, primed with common identifiers, long words and the text around the candidate, compresses it;
the bytes it adds over nothing, for each of its characters, are its novelty. Names, paths and words that
the surroundings or the dictionary hold cost few bytes; what costs nearly one byte for each character is
reported. Longer candidates are measured in equal pieces of up to 48 characters, each primed with those
before it too,
since of more characters zstandard writes random ones at their alphabet's entropy; one novel piece is
enough, as it would be if it stood alone. So long paths with unknown parts, and words of 16 letters or more
that the dictionary doesn't help with, are reported too. Lost is a value two lines or more from any
sensitive word and outside PEM marks.

Defined results: null is empty text; spans are code points, end exclusive, in order of start and then of
kind; repeated rows are each scanned; only doc_id is carried.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.ship import ship

# The forms.
KINDS = ("assign", "access", "hex", "novel")
WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")
HEX = re.compile(r"[0-9a-f]{16,}")

SENSITIVE = ("secret", "token", "passw", "passphrase", "credential", "bearer", "authorization", "api key", "apikey", "api_key", "private", "signature", "access_key", "session")
CONTEXT = re.compile("|".join(re.escape(w) for w in SENSITIVE), re.IGNORECASE | re.ASCII)
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
# PEM marks, and the lines of a key; line ends may be written as \n.
BEGIN, END = re.compile(r"-----BEGIN [A-Z0-9 ]{0,64}PRIVATE KEY[A-Z ]{0,64}-----"), "-----END"
KEY_LINE = re.compile(r"""[ \t]*+(?:[A-Za-z-]++: ?[^\n]*+|[A-Za-z0-9+/=_\\"',-]*+)[ \t\r]*+(?:\n|\Z)""")
BODY = re.compile(r"""(?<!\\)[A-Za-z0-9+/_=-]{16,}+(?:[ \t]*+(?:\\r)?(?:\\n|\r?\n)[ \t]*+[A-Za-z0-9+/=]++(?=[\s\\"',]|\Z))*+""")
LINE_ENDS = re.compile(r"\\[rn]|\s+")
AROUND, PIECE = 512, 48
NOVELTY = 0.9

# What code and configuration around secrets is made of.
IDENTIFIERS = " ".join(
    "abstract account address algorithm application argument array assert async attribute authenticate authorization "
    "backend base64 bearer boolean buffer bucket build byte callback certificate char class client cluster code column "
    "commit compare compile component config configuration connection const constructor container content context "
    "continue controller cookie count create credential current database datetime debug decode default define delete "
    "deploy description development digest directory document domain double element else email enabled encode encrypt "
    "endpoint entity enum environment error event example except exception execute export extends false field file "
    "filter final finally float format from function generate get global group handler hash header host http https "
    "identifier identity implements import index initialize input insert instance integer interface internal invalid "
    "iterator json kernel key label lambda language length library limit linux list load local localhost location log "
    "logger login long main manager map master message metadata method migration model module name namespace network "
    "node null number object option order output owner package page parameter parent parse passphrase password path "
    "payload permission platform plugin policy port prefix primary private process production profile project property "
    "protected protocol provider proxy public query queue random read record redirect region register release remote "
    "repository request require resource response result return role root route schema scope script secret secure "
    "security select self sequence server service session setting sha256 signature size socket source sql staging "
    "start state static status storage store stream string struct subject suffix super switch system table target task "
    "template test text thread timeout timestamp title token topic transaction true type unique update upload uri url "
    "user username uuid valid validate value variable vector version view void volume wait while window worker write "
    "xml yaml 0123456789 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ access_key api_key client_id "
    "client_secret private_key public_key "
    # Long words of prose, for their stems and endings.
    "accomplishment acknowledgement administration advertisement approximately archaeological characterization "
    "characteristically commercialization communications comprehensive conceptualization congratulations "
    "considerations constitutional contemporary contradictory correspondence counterproductive cryptography "
    "decentralization demonstration differentiation disappointment discrimination disproportionately electromagnetic "
    "entertainment entrepreneurship environmentally establishment experimentation extraordinarily fundamentally "
    "generalization globalization governmental hypothetically identification implementation incomprehensible "
    "inconsistencies independently individualistic industrialization infrastructure institutionalized instrumentation "
    "intellectually interconnected interdisciplinary internationalization interpretation investigations "
    "justification knowledgeable manufacturing mathematically microorganisms misinterpretation misunderstanding "
    "multidimensional nationalization neighbourhood notwithstanding organizational oversimplification "
    "parliamentary pharmaceutical philosophical photographers professionalism psychological qualifications "
    "recommendations rehabilitation representatives responsibilities revolutionary semiconductor simultaneously "
    "sophistication specialization standardization straightforward superintendent sustainability telecommunications "
    "transcontinental transformation transportation uncharacteristic unconstitutional understanding unfortunately "
    "unprecedented vulnerabilities".split()
).encode()


def novelty(text: str, start: int, end: int) -> float:
    """Marginal compressed bytes for each character of a candidate, given what surrounds it."""
    return _novelty(text[start:end], text[max(0, start - AROUND) : start] + "\n" + text[end : end + AROUND])


def _novelty(piece: str, around: str) -> float:
    import zstandard

    primer = zstandard.ZstdCompressionDict(IDENTIFIERS + b"\n" + around.encode("utf-8", "replace"), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    compressor = zstandard.ZstdCompressor(level=6, dict_data=primer, write_content_size=False, write_checksum=False, write_dict_id=False)
    return (len(compressor.compress(piece.encode())) - len(compressor.compress(b""))) / len(piece)


def is_novel(text: str, start: int, end: int, threshold: float = NOVELTY) -> bool:
    """Whether a piece of the candidate is novel. Line ends within it don't count."""
    name, before, after = LINE_ENDS.sub("", text[start:end]), text[max(0, start - AROUND) : start], text[end : end + AROUND]
    n = -(-len(name) // PIECE)
    cuts = [len(name) * i // n for i in range(n + 1)]
    # What follows a piece in its candidate is left out: only what stands before has been seen.
    return any(_novelty(name[a:b], (before + name[max(0, a - AROUND) : a])[-AROUND:] + "\n" + after) >= threshold for a, b in zip(cuts, cuts[1:]))


def fixed_spans(text: str) -> list[tuple[int, int, str]]:
    found = [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text)]
    low = text.lower()
    if any(w in low for w in WORDS):
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    return found


def key_spans(text: str) -> list[tuple[int, int]]:
    """What stands behind each BEGIN of a private key: up to its END, or, without one, as far as lines are
    those of a key."""
    found, at, closed = [], 0, True
    while begin := BEGIN.search(text, at):
        at = begin.end()
        end = text.find(END, at) if closed else -1
        if end < 0:
            closed, end = False, at  # none follows: that need not be asked again
            while end < len(text) and (line := KEY_LINE.match(text, end)):
                end = line.end()
        found.append((at, end))
        at = max(at, end)
    return found


def candidates(text: str) -> list[tuple[int, int]]:
    """Spans of the strings that sensitive words point to, in order."""
    keys = key_spans(text)
    found = [m.span() for a, b in keys for m in BODY.finditer(text, a, b)]
    lines, at = [], 0
    for line in text.split("\n"):
        if line.strip():
            lines.append((at, at + len(line)))
        at += len(line) + 1
    # The words and the keys part what stands beside them.
    words, near, i = [m.span() for m in CONTEXT.finditer(text)], set(), 0
    for a, _ in words:
        while lines[i][1] <= a:
            i += 1
        near.update((i - 1, i, i + 1))
    walls, k = sorted(words + keys), 0
    for i in sorted(near & set(range(len(lines)))):
        at, end = lines[i]
        while at < end:
            while k < len(walls) and walls[k][1] <= at:
                k += 1
            stop = min(end, walls[k][0]) if k < len(walls) else end
            found += [m.span() for m in CANDIDATE.finditer(text, at, stop)] if at < stop else []
            at = walls[k][1] if stop < end else end
    return sorted(set(found))


def novel_spans(text: str, threshold: float = NOVELTY) -> list[tuple[int, int, str]]:
    """Candidates, measured."""
    low = text.lower()
    if not any(w in low for w in SENSITIVE):
        return []
    return [(a, b, "novel") for a, b in candidates(text) if is_novel(text, a, b, threshold)]


def scan_text(text: str, threshold: float = NOVELTY) -> list[tuple[int, int, str]]:
    """All spans (start, end, kind). A candidate inside a fixed form's span is that form's already."""
    fixed = fixed_spans(text)
    new, reach, k = [], 0, 0
    by_start = sorted(fixed)
    for s in novel_spans(text, threshold):
        while k < len(by_start) and by_start[k][0] <= s[0]:
            reach = max(reach, by_start[k][1])
            k += 1
        if s[1] > reach:
            new.append(s)
    return sorted(fixed + new, key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def scan(docs: DataFrame, *, threshold: float = NOVELTY) -> DataFrame:
    """doc_id and `found`: kind, start and end of each span of the whole text."""
    ship(docs.sparkSession)
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                spans = scan_text(text.as_py() or "", threshold)
                rows.append([{"kind": k, "start": a, "end": b} for a, b, k in spans])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, pa.list_(span))], ["doc_id", "found"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, found array<struct<kind:string,start:int,end:int>>")
