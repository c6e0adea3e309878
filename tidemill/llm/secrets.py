"""Secret scans: fixed patterns, and credential values whose password guess cost is high.

The fixed patterns find long assigned values, access keys and hex runs. Beyond them, a value that stands in a credential context
(a key name, then : or =) is split at minimum cost into words, dates, repeats, sequences, keyboard walks and
brute-force spans; the cost is the logarithm of the guesses an attacker needs. Values above a threshold are secrets, however short;
placeholders and plain words are not. Words are a short common list, then those of the corpus itself by the documents that hold them.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import arrow_limits, materialize, remove, store

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"(?<![0-9a-f])[0-9a-f]{16,}")
ASSIGN_VALUE, ACCESS_LENGTH = 12, 18
KINDS = ("assign", "access", "hex", "guess")

#: Key names of a credential context, what may stand between name and value, and the value: quoted, blanks allowed, or up to a blank.
#: A longer name that ends with one of these after _ or - counts too.
CONTEXT = re.compile(r"""(?<![A-Za-z0-9])(?:password|passwd|passphrase|pwd|secret|token|api_?key|access_?key|private_?key|credentials?|auth)"""
                     r"""["']?[ \t]*(?::=|=>|[:=])[ \t]*(?:"([^"\r\n]+)"|'([^'\r\n]+)'|([^\s"'<>,;]+))""", re.I | re.A)
#: log10 of the guesses from which a value counts as a secret.
GUESSES = 8.0
#: Words an attacker tries first, most frequent first. Callers may pass their own ranking.
COMMON = ("password 123456 qwerty admin letmein welcome monkey dragon master login abc123 iloveyou secret changeme default test "
          "user root guest example demo sample token key value string none null true false your my the and for with this that "
          "here name pass hello world love football baseball shadow sunshine princess summer winter spring autumn server "
          "database local host public private access credential placeholder insert replace enter xxx foo bar baz").split()
#: A word of the corpus has so many letters, and so many rows of the corpus hold it; a letters-only secret copied that often is a word.
LETTERS, LEAST_DOCUMENTS = (3, 32), 5
#: Words a task counts before it hands them on.
COUNTED = 300_000
_LETTERS = re.compile(r"[^\W\d_]+")
ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")
LEET = str.maketrans("4@3601!5$7", "aaeboiisst")
DATE = re.compile(r"(?:19|20)\d\d[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])[-/._]?(?:0[1-9]|1[0-2])[-/._]?(?:19|20)\d\d|(?:19|20)\d\d")


def _neighbours() -> set[tuple[str, str]]:
    found = set()
    for r, row in enumerate(ROWS):
        for c, key in enumerate(row):
            for dr, dc in ((0, 1), (1, 0), (1, -1)):
                if r + dr < len(ROWS) and 0 <= c + dc < len(ROWS[r + dr]):
                    other = ROWS[r + dr][c + dc]
                    found |= {(key, other), (other, key)}
    return found


NEXT = _neighbours()


def brute_force(part: str) -> float:
    """log10 of the guesses for a span without structure: its length times the alphabet its characters come from."""
    alphabet = (26 * any("a" <= c <= "z" for c in part) + 26 * any("A" <= c <= "Z" for c in part) + 10 * any(c.isdigit() for c in part)
                + 33 * any(not c.isalnum() for c in part))
    return len(part) * math.log10(max(alphabet, 10))


class GuessCost:
    """log10 of the guesses for a value: the cheapest way to cut it into spans, found by dynamic programming."""

    def __init__(self, words=COMMON, further: dict[str, int] | None = None):
        """words by rank; further ranks come behind them."""
        self.ranks: dict[str, int] = {}
        for n, word in enumerate(words, 1):
            self.ranks.setdefault(word.lower(), n)
        for word, rank in (further or {}).items():
            self.ranks.setdefault(word, len(words) + rank)
        self.longest = max(map(len, self.ranks), default=0)

    def spans(self, value: str):
        """(start, end, cost, kind) of every span that has a structure."""
        low, size = value.lower(), len(value)
        plain = low.translate(LEET)
        for i in range(size):
            for j in range(i + 3, min(size, i + self.longest) + 1):
                for form, extra in ((low, 0.0), (plain, 0.5)):
                    rank = self.ranks.get(form[i:j])
                    if rank:
                        shifts = sum(c.isupper() for c in value[i:j])
                        yield i, j, math.log10(rank) + extra + (0.3 if shifts in (0, j - i) else 0.3 * (1 + shifts)), "word"
                        break
            for m in (DATE.match(value, i),):
                if m:
                    yield i, m.end(), math.log10(120 * (366 if m.end() - i > 4 else 1)), "date"
        for i, j in _runs(low, lambda a, b: (a, b) in NEXT):
            yield i, j, math.log10(47 * 6) + 0.4 * (j - i), "walk"
        for step in (1, -1):
            for i, j in _runs(low, lambda a, b, s=step: ord(b) - ord(a) == s):
                yield i, j, math.log10(26 * 2 * (j - i)), "sequence"
        for width in range(1, min(16, size // 2) + 1):
            i = 0
            while i + 2 * width <= size:
                j = i + width
                while value[j:j + width] == value[i:i + width]:
                    j += width
                if j - i >= max(3, 2 * width):
                    yield i, j, brute_force(value[i:i + width]) + math.log10((j - i) // width), "repeat"
                    i = j
                else:
                    i += 1

    def segments(self, value: str) -> tuple[float, list[tuple[int, int, str]]]:
        """The least cost and its spans. Each span costs its own guesses; a further span adds a little for the choice of cuts."""
        size, ends = len(value), {}
        for i, j, cost, kind in self.spans(value):
            ends.setdefault(j, []).append((i, cost, kind))
        alphabet = brute_force(value) / max(size, 1)
        best = [(0.0, None)] + [(math.inf, None)] * size
        for j in range(1, size + 1):
            # a brute-force span grows by one character at a time
            before = best[j - 1]
            opened = 0.0 if before[1] is None or before[1][2] == "brute" else 0.3
            best[j] = (before[0] + alphabet + opened, (j - 1, j, "brute"))
            for i, cost, kind in ends.get(j, ()):
                total = best[i][0] + cost + 0.3 * (i > 0)
                if total < best[j][0]:
                    best[j] = (total, (i, j, kind))
        cut, j = [], size
        while j:
            i, _, kind = best[j][1]
            if kind == "brute" and cut and cut[-1][2] == "brute":
                cut[-1] = (i, cut[-1][1], kind)
            else:
                cut.append((i, j, kind))
            j = i
        return best[size][0], cut[::-1]

    def __call__(self, value: str) -> float:
        return self.segments(value)[0]


def _runs(text: str, follows):
    """Maximal stretches of three or more characters, each following the one before."""
    start = 0
    for k in range(1, len(text) + 1):
        if k == len(text) or not follows(text[k - 1], text[k]):
            if k - start >= 3:
                yield start, k
            start = k


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the fixed patterns: the whole match, in code points, by start and then kind."""
    found = []
    if ":" in text or "=" in text:
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LENGTH]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def guess_spans(text: str, base, cost: GuessCost, threshold: float = GUESSES) -> list[tuple[str, int, int, float]]:
    """Values in credential contexts with a guess cost above the threshold that no base span covers."""
    if ":" not in text and "=" not in text:
        return []
    found = []
    for m in CONTEXT.finditer(text):
        start, end = next(m.span(n) for n in (1, 2, 3) if m[n] is not None)
        if any(s <= start and end <= e for _, s, e in base):
            continue
        guesses = cost(text[start:end].rstrip(".)]}"))
        if guesses >= threshold:
            found.append(("guess", start, end, guesses))
    return found


def scan(text: str, cost: GuessCost, threshold: float = GUESSES):
    """(base spans, all spans, largest guess cost of an added span)."""
    base = base_spans(text)
    added = guess_spans(text, base, cost, threshold)
    spans = sorted([*base, *(a[:3] for a in added)], key=lambda s: (s[1], KINDS.index(s[0])))
    return base, spans, max((a[3] for a in added), default=0.0)


def join_spans(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def parts_of(value: str) -> set[str]:
    """The strings of letters in a value, also with leet characters read as letters, that may be words."""
    found, low = set(), value.lower()
    for form in {low, low.translate(LEET)}:
        for m in _LETTERS.finditer(form):
            run = m[0]
            found.update(run[i:j] for i in range(len(run)) for j in range(i + LETTERS[0], min(len(run), i + LETTERS[1]) + 1))
    return found


def _word_tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n): in how many rows of (text) a word stands; a word may come in several parts."""
    counts: Counter[str] = Counter()

    def rows():
        found = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
        counts.clear()
        return found

    for batch in batches:
        for text in batch.column(0):
            counts.update({w for w in _LETTERS.findall((text.as_py() or "").lower()) if LETTERS[0] <= len(w) <= LETTERS[1]})
            if len(counts) > COUNTED:
                yield rows()
    yield rows()


def _part_tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(v, word) of (v, value)."""
    for batch in batches:
        for v, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            parts = sorted(parts_of(value))
            yield pa.RecordBatch.from_arrays([pa.array([v] * len(parts), pa.int64()), pa.array(parts, pa.string())], names=["v", "word"])


def value_costs(values: DataFrame, texts: DataFrame, words, made: list[str]) -> DataFrame:
    """(value, cost): log10 of the guesses for distinct values, with the words of texts (text) ranked behind the given ones.

    Words with about as many rows (an eighth of a power of two) share a rank, the number of words that have as many or more. The
    paths of work tables are added to `made`: the caller deletes them, as they hold values.
    """
    values, path = store(values.select("value").distinct().withColumn("v", F.monotonically_increasing_id()), "values")
    made.append(path)
    known = texts.mapInArrow(_word_tasks, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_DOCUMENTS)
    known, path = store(known.select("word", F.floor(F.log2("n") * 8).cast("int").alias("bucket")), "words")
    made.append(path)
    ranks, total = {}, 0
    for bucket, count in sorted(known.groupBy("bucket").count().collect(), reverse=True):
        ranks[bucket] = total = total + count
    held = (values.select("v", "value").mapInArrow(_part_tasks, "v long, word string").join(known, "word")
            .groupBy("v").agg(F.collect_list(F.struct("word", "bucket")).alias("held")))

    @F.arrow_udf("double")
    def costs(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for batch, own in batches:
            yield pa.array([GuessCost(words, {h["word"]: ranks[h["bucket"]] for h in held or ()})(value.rstrip(".)]}"))
                            for value, held in zip(batch.to_pylist(), own.to_pylist())], pa.float64())

    return values.join(held, "v", "left").select("value", costs("value", "held").alias("cost"))


def find_secrets(docs: DataFrame, threshold: float = GUESSES, words=COMMON) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_guess, max_guess_log10: one row per row of docs.

    Null text counts as empty: no spans, the digest of the empty string. Repeated rows and null ids give their own rows. Spans count code
    points, whole texts are read, other columns are not. words are tried first; then come the words of docs. The values found stand in
    work tables only while this runs; the result names their places.
    """
    arrow_limits(docs.sparkSession)
    words = tuple(words)
    fields = [("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()),
              ("base", pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.int64()), ("span", pa.string())]))),
              ("open", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())])))]

    @F.arrow_udf("struct<n_assign: long, n_access: long, n_hex: long, base_sha256: string, base: array<struct<start: long, kind: long, span: string>>, "
                 "open: array<struct<start: long, end: long, value: string>>>")
    def secrets(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        cost = GuessCost(words)
        for batch in batches:
            rows = []
            for value in batch:
                text = value.as_py() or ""
                base = base_spans(text)
                kinds = [s[0] for s in base]
                rows.append({"n_assign": kinds.count("assign"), "n_access": kinds.count("access"), "n_hex": kinds.count("hex"),
                             "base_sha256": hashlib.sha256(join_spans(base).encode()).hexdigest(),
                             "base": [{"start": s[1], "kind": KINDS.index(s[0]), "span": join_spans([s])} for s in base],
                             # further words only make a value cheaper, so what is cheap without them needs none
                             "open": [{"start": s[1], "end": s[2], "value": text[s[1]:s[2]]} for s in guess_spans(text, base, cost, threshold)]})
            yield pa.array(rows, pa.struct(fields))

    text = F.col("text").cast("string")
    made: list[str] = []
    try:
        rows, path = store(docs.select("doc_id", F.monotonically_increasing_id().alias("r"), secrets(text).alias("s")).select("doc_id", "r", "s.*"), "secrets")
        made.append(path)
        opened = rows.select("r", F.explode("open").alias("o")).select("r", "o.start", "o.end", "o.value")
        guessed = opened.join(value_costs(opened, docs.select(text.alias("text")), words, made), "value").filter(F.col("cost") >= threshold)
        guessed = guessed.groupBy("r").agg(F.max("cost").alias("most"), F.collect_list(F.struct(
            "start", F.lit(KINDS.index("guess")).cast("long").alias("kind"), F.concat_ws(":", F.lit("guess"), "start", "end").alias("span"))).alias("more"))
        found = rows.join(guessed, "r", "left").withColumn("more", F.coalesce("more", F.slice("base", 1, 0)))
        return materialize(found.select(
            "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", F.array_join(F.sort_array(F.concat("base", "more")).getField("span"), ",").alias("spans"),
            F.size("more").cast("long").alias("n_guess"), F.coalesce("most", F.lit(0.0)).alias("max_guess_log10")), "secret-spans")
    finally:
        for path in made:
            remove(docs.sparkSession, path)
