"""Secret scans: fixed patterns, and values in a credential context whose guess cost is high.

The guess cost of a value is the least cost of a segmentation into dictionary words, dates, repeats, keyboard walks and
brute-force characters, as a power of ten of guesses (dynamic programming over the places of the value). Values
that cost ``MIN_COST`` or more are spans of kind ``guess``; ``password=password123`` or ``token: aaaaaaaaaa`` are not.
The dictionary holds common words of passwords and the words of the corpus, ranked by the number of documents that have them;
what stands in a credential context is not counted, so a secret that is repeated there does not become a word.

Edge cases: a null or empty text has no spans; places are code points, the end is exclusive; kinds may overlap each
other, spans of a kind never do; repeated rows are scanned one by one; a very long value is scored whole, in time
proportional to its length; words of equal rank are ordered by their letters; an empty table gives no rows; other columns are not
read, and ``redact`` hands them on as they are.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmill.llm.texts import by_bytes, id_and_text, keep, map_texts, strings

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "guess")
MIN_COST = 10.0
SPANS = "doc_id long, spans array<struct<kind:string,start:int,end:int,cost:double>>"


def either_case(word: str) -> str:
    """A pattern for ASCII letters in either case, and for no other letter that folds to them."""
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


NAMES = "|".join(map(either_case, ("password", "passwd", "secret", "token", "api_?key")))
ASSIGN = re.compile(rf"""({NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
CONTEXT_NAMES = "|".join(map(either_case, (
    "password", "passwd", "passphrase", "pwd", "secret", "token", "api[_-]?key", "access[_-]?key", "private[_-]?key",
    "credentials?", "bearer", "auth(?:orization|entication)?")))
# The name ends at a word's end: of the text, before a digit, _ or -, or before a capital behind a small letter.
CONTEXT = re.compile(rf"""(?:{CONTEXT_NAMES})[sS]?(?:(?:[0-9_-]|(?<=[a-z])[A-Z])[A-Za-z0-9_-]{{0,31}})?["']?"""
                     r"""(?:\x20*[:=]|\x20+is(?=\x20))\x20*["']?([^\s"'`<>,;]+)""")

# Common words of passwords, the likelier first.
WORDS = """
password pass qwerty admin welcome login letmein secret monkey dragon master hello freedom whatever shadow sunshine
princess football baseball superman batman trustno iloveyou love summer winter spring autumn monday friday test guest
user root default changeme token key api access example sample demo temp null none true false value string your my the
""".split()
WORD_COST = {word: math.log10(rank + 2) for rank, word in enumerate(WORDS)}
LONGEST_WORD = 24  # letters; longer words are met by their parts
WORD = re.compile(rf"(?<![^\W\d_])[^\W\d_]{{3,{LONGEST_WORD}}}(?![^\W\d_])")
LEAST_DOCS = 2  # documents that have a word of the dictionary
RANKED_WORDS = 200_000  # a few MB on the driver and in each task
COUNTED_WORDS = 200_000  # held by a task at a time
LEET = str.maketrans("013457@$!", "oieastasi")
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
DATE = re.compile(r"(?:19|20)\d\d(?:[-/._]?(?:0[1-9]|1[0-2])(?:[-/._]?(?:0[1-9]|[12]\d|3[01]))?)?"
                  r"|(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)\d\d")
DATE_COST = math.log10(365 * 120)


def neighbours() -> set[tuple[str, str]]:
    """Keys side by side, or one below the other."""
    out = set()
    for row in ROWS:
        out |= {(a, b) for a, b in zip(row, row[1:])}
    for upper, lower in zip(ROWS, ROWS[1:]):
        out |= {(upper[i], lower[j]) for i in range(len(upper)) for j in (i - 1, i) if 0 <= j < len(lower)}
    return out | {(b, a) for a, b in out}


NEAR = neighbours()


def character_cost(c: str) -> float:
    """Brute force: the size of the class that the character comes from."""
    if c.isdigit() and c.isascii():
        return 1.0
    if c.isascii() and c.isalpha():
        return math.log10(26)
    return math.log10(33) if c.isascii() else 2.0


def segments(value: str, words: Mapping[str, float] = WORD_COST) -> Iterator[tuple[int, int, float]]:
    """(start, end, cost) of every pattern in ``value``."""
    low = value.lower()
    if len(low) != len(value):
        low = value
    plain = low.translate(LEET)
    n = len(value)
    for start in range(n):
        for end in range(start + 2, min(n, start + LONGEST_WORD) + 1):
            word = low[start:end]
            cost = words.get(word)
            if cost is None:
                cost = words.get(plain[start:end])
                cost = None if cost is None else cost + 0.5
            if cost is not None:
                yield start, end, cost + (0.0 if value[start:end] == word else 0.3)
        if found := DATE.match(value, start):
            yield start, found.end(), DATE_COST if found.end() - start > 4 else math.log10(150)
    for walk, cost in ((lambda a, b: a == b, 0.0), (lambda a, b: (a, b) in NEAR, 0.35)):
        start = 0
        for end in range(1, n + 1):
            if end == n or not walk(low[end - 1], low[end]):
                if end - start >= 3:
                    yield start, end, character_cost(value[start]) + math.log10(end - start) + cost * (end - start)
                start = end


def guess_cost(value: str, words: Mapping[str, float] = WORD_COST) -> float:
    """Least cost, as a power of ten, of a segmentation of the whole ``value``; 0 for the empty one."""
    ending: dict[int, list[tuple[int, float]]] = {}
    for start, end, cost in segments(value, words):
        ending.setdefault(end, []).append((start, cost + 0.3))
    best = [0.0] * (len(value) + 1)
    for end in range(1, len(value) + 1):
        cost = best[end - 1] + character_cost(value[end - 1])
        for start, more in ending.get(end, ()):
            if best[start] + more < cost:
                cost = best[start] + more
        best[end] = cost
    return best[-1]


def find_spans(text: str, min_cost: float = MIN_COST, words: Mapping[str, float] = WORD_COST) -> list[tuple[str, int, int, float | None]]:
    """(kind, start, end, cost) in ``text``, by start and then by kind."""
    out: list[tuple[str, int, int, float | None]] = []
    if ":" in text or "=" in text:
        out += [("assign", *m.span(), None) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [("access", *m.span(), None) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [("hex", *m.span(), None) for m in HEX.finditer(text)]
    for m in CONTEXT.finditer(text):
        value = m[1].rstrip(".:!?)]}")
        if value and (cost := guess_cost(value, words)) >= min_cost:
            out.append(("guess", m.start(1), m.start(1) + len(value), cost))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def redact_text(text: str, spans: list[tuple[str, int, int, float | None]]) -> str:
    """``text`` with each stretch of overlapping spans replaced by the name of its first kind."""
    out, done, until = [], 0, -1
    for kind, start, end, _ in spans:
        if start >= until:
            out += [text[done:start], f"[{kind}]"]
        until = max(until, end)
        done = until
    return "".join([*out, text[done:]])


def word_costs(docs: DataFrame, text_col: str = "text") -> dict[str, float]:
    """Costs of the common words and of those that ``LEAST_DOCS`` documents or more have outside credential contexts."""

    def run(batches):
        counts: Counter[str] = Counter()
        for batch in by_bytes(batches):
            for text in strings(batch.column("text")):
                counts.update(set(WORD.findall(CONTEXT.sub(" ", text).lower())))
                if len(counts) > COUNTED_WORDS:
                    yield rows(counts)
                    counts.clear()
        yield rows(counts)

    def rows(counts):
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                                          names=["word", "docs"])

    counted = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "word string, docs long")
    counted = keep(counted.groupBy("word").agg(F.sum("docs").alias("docs")).filter(F.col("docs") >= LEAST_DOCS), "secret-words")
    least, share = LEAST_DOCS, 1.0  # of the words with the least number of documents a share, so that few come to the driver
    room = RANKED_WORDS
    for n, size in sorted(map(tuple, counted.groupBy("docs").count().collect()), reverse=True):
        if size > room:
            least, share = n, room / size
            break
        room -= size
    part = F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < int(share * (1 << 20))
    chosen = counted.filter((F.col("docs") > least) | ((F.col("docs") == least) & part)).collect()
    ranked = sorted(chosen, key=lambda r: (-r.docs, r.word))
    costs = {r.word: math.log10(rank + 2) for rank, r in enumerate(ranked)}
    return costs | {word: min(cost, costs.get(word, cost)) for word, cost in WORD_COST.items()}


def scan(docs: DataFrame, min_cost: float = MIN_COST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, spans: a row for each row of ``docs``."""

    costs = docs.sparkSession.sparkContext.broadcast(word_costs(docs, text_col))

    def run(batch: pa.RecordBatch, texts: list[str]):
        words = costs.value
        found = [find_spans(t, min_cost, words) for t in texts]
        return batch.column("doc_id"), [[dict(zip(("kind", "start", "end", "cost"), s)) for s in x] for x in found]

    return map_texts(id_and_text(docs, id_col, text_col), run, SPANS)


def redact(docs: DataFrame, min_cost: float = MIN_COST, text_col: str = "text") -> DataFrame:
    """``docs`` with its spans replaced in ``text_col``; rows without spans, null texts too, are as they were."""
    names = docs.columns
    place = names.index(text_col)
    costs = docs.sparkSession.sparkContext.broadcast(word_costs(docs, text_col))

    def run(batches):
        words = costs.value
        for batch in by_bytes(batches, text_col):
            texts = batch.column(place).to_pylist()
            out = [t if t is None else redact_text(t, find_spans(t, min_cost, words)) for t in texts]
            columns = list(batch.columns)
            columns[place] = pa.array(out, batch.schema.field(place).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)


def listed(spans: Column, kinds: tuple[str, ...]) -> Column:
    """kind:start:end of the spans of ``kinds``, comma-joined."""
    own = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(own, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
