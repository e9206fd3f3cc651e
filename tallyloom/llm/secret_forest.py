"""Secrets in text: wide candidate rule, then a random forest that removes false positives.

A candidate is a run of at least `LEAST` characters of `[A-Za-z0-9+/_=-]` with a digit, cut behind
the name of an assignment without blanks (`NAME=value`) and around known formats; or any value of at least `SHORT`
bytes, whatever its signs and however long, that is assigned to a name which announces a secret (.env, YAML, JSON, URL
queries), or the password of a URL. Its features are length, character transitions (changes of class, surprise of its letter pairs in this
corpus, entropy), how much of it words of the corpus cover, path signs around and inside it, and its
neighbouring words (other names that announce secrets, common words).

A forest trained by MLlib on labelled findings votes on every candidate; known formats alone are
secrets without it. How a candidate is assigned is no feature: it is the evidence that labels findings where the
caller has no labels (`sure_label`), and it sets the vote needed (`VOTES`): a value announced
in machine form is dropped only by a clear vote, words in the place of a value are kept as text unless the vote is clear.

Letter pairs and the dictionary are counted over all texts; the dictionary holds words with a share
of at least `word_share` of all words, so it has at most 1 / word_share entries. The forest is fitted
on at most `max_rows` labelled findings by hash order. It is sent to the tasks as small arrays, so
documents are scanned, judged and redacted in place without a shuffle.

Defined results: null and empty texts have no candidates and stay as they are; findings without a
label are not learnt from; labels of one kind only give that label to every candidate, and without
labels nothing is removed; repeated rows each give a row; an empty table gives no rows. Input columns pass through unchanged, but for the redacted text; a column named like an added one is an error.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import words as tw

LEAST = 16
BODY = np.ones(256, bool)
BODY[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")] = False
KINDS = np.full(256, 4, np.int8)
KINDS[48:58], KINDS[97:123], KINDS[65:91] = 1, 2, 3
HEX = np.frombuffer(b"0123456789abcdefABCDEF", np.uint8)
LETTERS = np.ones(256, bool)
LETTERS[65:91] = LETTERS[97:123] = LETTERS[128:] = False
NAMES = ("token", "secret", "password", "passwd", "pwd", "key", "auth", "bearer", "credential", "signature")
KNOWN = re.compile(rb"(?<![0-9A-Za-z])(AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{30,}|xox[abps]-[0-9A-Za-z-]{10,}|sk_live_[0-9A-Za-z]{16,})"
                   rb"(?![0-9A-Za-z])")
SHORT = 4
COVER = 1 << 16  # bytes whose dictionary cover is looked up at a time
# least share of the limit that a vote needs, by the evidence of the place: none, announced in machine form, words for a value
PLAIN, ANNOUNCED_VALUE, WORDS = 0, 1, 2
VOTES = np.array([1.0, 0.4, 1.6])
NAMED_CUT = re.compile(rb"[A-Za-z0-9_-]*[A-Za-z][A-Za-z0-9_-]*=(?=[^=])")
# a name that announces a secret, up to its assignment sign; group 1 is what stands before it on the line
ANNOUNCED = re.compile(
    rb"(?i)([^\n]*?)(?<![A-Za-z0-9])(?:[A-Za-z0-9]+[_.-]+)*[A-Za-z0-9]*?"
    rb"(?:password|passwd|passphrase|passcode|(?<![A-Za-z])pass|pwd|secret|token|credential|"
    rb"(?:api|access|secret|private|auth|encryption|account)[_ -]?key)[0-9]*\\?[\"'`]?[ \t]*$")
VALUE = re.compile(rb"(=|:=|=>|:)?([ \t]*)(?:(?:Bearer|Basic|Token)[ \t]+)?(?:\\?([\"'`])([^\"'`\\\n]+)\\?\3|([^\s\"'`,;<>()\[\]{}&|\\]+))", re.I)
LINE = re.compile(rb"[^\s\"'`]+")
EMPTY = re.compile(rb"(?i)(null|none|nil|true|false|undefined|required|optional|x+|\*+|\.+|string|str|int|bytes)$|\$?[{(]|\$\(|%\(|<|[A-Za-z_][\w.]*\(")
URL_PASSWORD = re.compile(rb":([^\s/@]+)@")
USERINFO = re.compile(rb"://[^\s/:@]*$")
AROUND = 64  # bytes of context read on each side
FEATURES = ("length", "class_changes", "surprise", "entropy", "digits", "hex", "upper", "covered", "slashes",
            "path_before", "path_after", "named", "common_before", "common_after")
SPELT = re.compile(rb"[A-Za-z]+([-_ ][A-Za-z]+)+")


@dataclass
class Lexicon:
    """Surprise of letter pairs (nats) and hashes of common words, ascending."""

    pairs: np.ndarray
    words: np.ndarray


@dataclass
class Forest:
    """Trees as arrays: feature, threshold, left, right, vote; -1 marks leaves. Without trees
    every vote is `only`."""

    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    only: float = 1.0

    def votes(self, x: np.ndarray) -> np.ndarray:
        if not self.trees:
            return np.full(len(x), self.only)
        total = np.zeros(len(x))
        for feature, cut, left, right, vote in self.trees:
            at = np.zeros(len(x), np.int64)
            while len(open_ := np.flatnonzero(feature[at] >= 0)):
                node = at[open_]
                at[open_] = np.where(x[open_, feature[node]] <= cut[node], left[node], right[node])
            total += vote[at]
        return total / len(self.trees)


def learn_lexicon(docs: DataFrame, *, text: str, word_share: float = 5e-5) -> Lexicon:
    """Letter pairs and common words of four letters or more, over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, words = np.zeros(27 * 27, np.int64), []
            for piece in tw.pieces(tw.texts_of(batch.column(0))):
                low = tw.LOWER[piece.data].astype(np.int64)
                code = np.where((low >= 97) & (low <= 122), low - 96, 0)
                pairs += np.bincount(code[:-1] * 27 + code[1:], minlength=27 * 27)
                parts = tw.split(piece, LETTERS)
                words.append(tw.hash_spans(piece.data, parts.start, parts.end, tw.LOWER)[parts.end - parts.start >= 4])
            key, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *words]), return_counts=True)
            seen = np.flatnonzero(pairs)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([np.ones(len(key), bool), np.zeros(len(seen), bool)])),
                 pa.array(np.concatenate([key.view(np.int64), seen])), pa.array(np.concatenate([n, pairs[seen]]))],
                ["word", "key", "n"])

    counts = docs.select(F.col(text).cast("string").alias("t")).mapInArrow(count, "word boolean, key long, n long") \
        .groupBy("word", "key").agg(F.sum("n").alias("n")).persist()
    total = counts.where("word").agg(F.sum("n")).first()[0] or 0
    common = counts.where(F.col("word") & (F.col("n") >= max(2, math.ceil(word_share * total)))).select("key").toArrow()
    table = np.ones((27, 27))
    for r in counts.where(~F.col("word")).collect():
        table[r["key"] // 27, r["key"] % 27] += r["n"]
    counts.unpersist()
    return Lexicon(-np.log(table / table.sum(1, keepdims=True)), np.sort(common.column("key").to_numpy().view(np.uint64)))


def _known_words(lexicon: Lexicon, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    if not len(start) or not len(lexicon.words):
        return np.zeros(len(start), bool)
    h = tw.hash_spans(data, start, end, tw.LOWER)
    at = np.minimum(np.searchsorted(lexicon.words, h), len(lexicon.words) - 1)
    return lexicon.words[at] == h


def _covered(data: np.ndarray, lexicon: Lexicon) -> float:
    """Share of the bytes that lie in a common word of 4 to 12 letters."""
    total, n = 0, len(data)
    for at in range(0, n, COVER):
        low = max(0, at - 11)
        part = data[low:at + COVER + 11]
        letters = np.concatenate([[0], np.cumsum(~LETTERS[part] & (part < 128))])
        marks = np.zeros(len(part) + 1, np.int64)
        for k in range(4, min(12, len(part)) + 1):
            start = np.flatnonzero(letters[k:] - letters[:-k] == k)
            start = start[_known_words(lexicon, part, start, start + k)]
            np.add.at(marks, start, 1)
            np.add.at(marks, start + k, -1)
        total += int((np.cumsum(marks[:-1]) > 0)[at - low:at - low + COVER].sum())
    return total / n


def describe(body: bytes, before: bytes, after: bytes, lexicon: Lexicon) -> list[float]:
    """The FEATURES of one candidate between its contexts."""
    n = len(body)
    data = np.frombuffer(body, np.uint8)
    kinds = KINDS[data]
    low = tw.LOWER[data]
    letter = (low >= 97) & (low <= 122)
    both = letter[1:] & letter[:-1]
    pairs = lexicon.pairs[low[:-1][both] - 96, low[1:][both] - 96]
    share = np.bincount(data, minlength=256) / n
    seen = share[share > 0]
    left, right = re.findall(rb"[A-Za-z\x80-\xff]+", before)[-3:], re.findall(rb"[A-Za-z\x80-\xff]+", after)[:1]
    sides = [*left[-1:], *right]
    ends = np.cumsum([len(w) for w in sides], dtype=np.int64)
    common = iter(_known_words(lexicon, np.frombuffer(b"".join(sides), np.uint8),
                               ends - np.array([len(w) for w in sides], np.int64), ends).tolist())
    near = b" ".join([*left[:-1], *right]).lower()  # without the name of the value itself
    return [
        float(n), float((kinds[1:] != kinds[:-1]).sum()) / max(1, n - 1), float(pairs.mean()) if len(pairs) else 0.0,
        float(-(seen * np.log2(seen)).sum()), float((kinds == 1).mean()), float(share[HEX].sum()),
        float((kinds == 3).mean()), _covered(data, lexicon), float((data == 47).sum()),
        float(before[-1:] in (b"/", b"\\", b".", b"@")), float(bool(re.match(rb"[.@/\\][A-Za-z]", after))),
        float(any(x.encode() in near for x in NAMES)),
        float(next(common)) if left else 0.0, float(next(common)) if right else 0.0,
    ]


def evidence(body: bytes, before: bytes, announced: bool) -> int:
    """What the place of a candidate says: PLAIN, ANNOUNCED_VALUE or WORDS."""
    if not announced:
        return PLAIN
    if SPELT.fullmatch(body) or (body.isalpha() and body.isascii() and before[-1:] not in (b"=", b'"', b"'", b"`")):
        return WORDS
    return PLAIN if body[:1] == b"/" or body[:2] == b"./" or b"://" in body else ANNOUNCED_VALUE


def sure_label(body: bytes, before: bytes, announced: bool = False) -> int | None:
    """Label of a finding by its place, else None: known formats, and quoted values of an announcing name that are neither a
    number nor words, are secrets; what stands in running text without a name, a sign of assignment or quotes is not."""
    if KNOWN.fullmatch(body):
        return 1
    bare = before.rstrip(b" \t\"'`")
    assigned, quoted = bare[-1:] in (b"=", b":"), before[-1:] in (b'"', b"'", b"`")
    left = b" ".join(re.findall(rb"[A-Za-z\x80-\xff]+", before)[-3:]).lower()
    named = any(x.encode() in left for x in NAMES)
    if (announced or (named and assigned)) and quoted:
        return 0 if SPELT.fullmatch(body) else None if body.isdigit() else 1
    if SPELT.fullmatch(body) and not quoted:
        return 0
    return None if announced or named or assigned or quoted else 0


def _announced(piece: tw.Texts) -> list[tuple[int, int, int]]:
    """Row, start and end of the values that a name announces, and of passwords in URLs."""
    signs = np.flatnonzero((piece.data == 61) | (piece.data == 58))
    if not len(signs):
        return []
    out, last, body_of, body_row = [], -1, b"", -1
    rows = np.searchsorted(piece.bounds, signs, "right") - 1
    for at, row in zip(signs.tolist(), rows.tolist()):
        if at < last:
            continue
        low, high = int(piece.bounds[row]), int(piece.bounds[row + 1])
        before = piece.data[max(low, at - AROUND):at].tobytes()
        if row != body_row:
            body_of, body_row = piece.bytes_of(row), row
        here = at - low  # values are matched in place, to their end
        ahead = body_of[here:here + 4]
        if ahead[:1] == b":" and (user := USERINFO.search(before)):
            if found := URL_PASSWORD.match(body_of, here):
                out.append((row, at + 1, low + found.end(1)))
                last = low + found.end(1)
            continue
        # a name, or one before the first sign of := and =>
        line = before.rsplit(b"\n", 1)[-1]
        name = ANNOUNCED.match(line[:-1] if line[-1:] == b":" and ahead[:1] == b"=" else line)
        if not name:
            continue
        found = VALUE.match(body_of, here)
        if not found or ahead[:2] in (b"==", b"::") or ahead[:3] == b"://":
            continue
        start, end = found.span(4) if found.group(3) else found.span(5)
        if not found.group(3):
            whole = ahead[:1] == b"=" and start == here + 1 and name.group(1).strip() in (b"", b"export", b"set") \
                and LINE.match(body_of, here + 1)
            if whole:
                end = whole.end()
            end -= len(body_of[start:end]) - len(body_of[start:end].rstrip(b".,;:"))
        body = body_of[start:end]
        number = body.isdigit() and len(body) < LEAST and not re.search(rb"(?i)pass|pwd", line)
        if len(body) < SHORT or EMPTY.match(body) or number or body.count(b" ") > 5:
            continue
        out.append((row, low + start, low + end))
        last = low + end
    return out


def _candidates(piece: tw.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows, starts and ends of the candidates, in order, and which of them a name announces."""
    parts = tw.split(piece, BODY)
    digits = np.concatenate([[0], np.cumsum((piece.data >= 48) & (piece.data <= 57))])
    good = (parts.end - parts.start >= LEAST) & (digits[parts.end] > digits[parts.start])
    values = _announced(piece)
    begin = np.array([a for _, a, _ in values], np.int64)
    found = [(*v, True) for v in values]
    for row, start, end in zip(parts.row[good].tolist(), parts.start[good].tolist(), parts.end[good].tolist()):
        body, cuts = piece.data[start:end].tobytes(), {start, end}
        if b"=" in body and (name := NAMED_CUT.search(body)):
            cuts.add(start + name.end())
        for known in KNOWN.finditer(body):
            cuts |= {start + known.start(), start + known.end()}
        held = values[max(0, int(np.searchsorted(begin, start, "right")) - 1):int(np.searchsorted(begin, end))]
        held = [(a, b) for _, a, b in held if a < end and b > start]
        for a, b in held:
            cuts |= {max(a, start), min(b, end)}
        places = sorted(cuts)
        found += [(row, a, b, False) for a, b in zip(places, places[1:])
                  if b - a >= LEAST and digits[b] > digits[a] and not any(x <= a and b <= y for x, y in held)]
    found.sort()
    rows, starts, ends, announced = zip(*found) if found else ((), (), (), ())
    return np.array(rows, np.int64), np.array(starts, np.int64), np.array(ends, np.int64), np.array(announced, bool)


def _context(piece: tw.Texts, row: int, start: int, end: int) -> tuple[bytes, bytes, bytes]:
    low, high = piece.bounds[row], piece.bounds[row + 1]
    cut = lambda a, b: piece.data[max(a, low):min(b, high)].tobytes()
    return cut(start, end), cut(start - AROUND, start), cut(end, end + AROUND)


def find(docs: DataFrame, lexicon: Lexicon, *, text: str) -> DataFrame:
    """All candidates: candidate, features, label (by `sure_label`, or null)."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in tw.pieces(tw.texts_of(batch.column(0))):
                bodies, rows, labels = [], [], []
                for row, start, end, announced in zip(*(x.tolist() for x in _candidates(piece))):
                    body, before, after = _context(piece, row, start, end)
                    x = describe(body, before, after, shared.value)
                    bodies.append(body.decode())
                    rows.append(x)
                    labels.append(sure_label(body, before, announced))
                if bodies:
                    yield pa.RecordBatch.from_arrays([pa.array(bodies), pa.array(rows, pa.list_(pa.float64())),
                                                      pa.array(labels, pa.int32())], ["candidate", "features", "label"])

    return docs.select(F.col(text).cast("string").alias("t")).mapInArrow(
        scan, "candidate string, features array<double>, label int")


def _arrays(tree: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One tree from MLlib's printed form."""
    lines = iter(tree.splitlines()[1:])
    feature, cut, left, right, vote = [], [], [], [], []

    def node() -> int:
        at = len(feature)
        line = next(lines).strip()
        for part in (feature, left, right):
            part.append(-1)
        cut.append(0.0)
        vote.append(0.0)
        if line.startswith("Predict:"):
            vote[at] = float(line.split(":")[1])
            return at
        feature[at], cut[at] = (f(x) for f, x in zip((int, float), re.search(r"feature (\d+) <= (\S+?)\)", line).groups()))
        left[at] = node()
        next(lines)  # the Else line
        right[at] = node()
        return at

    node()
    return tuple(np.array(x) for x in (feature, cut, left, right, vote))


def fit(findings: DataFrame, *, max_rows: int = 20_000, trees: int = 30, depth: int = 6, seed: int = 7) -> Forest:
    """Train on labelled findings (features, label 0 or 1)."""
    rows = findings.where(F.col("label").isin(0, 1)).orderBy(F.xxhash64("candidate"), "candidate", "label") \
        .limit(max_rows).select(array_to_vector("features").alias("features"), F.col("label").cast("double").alias("label"))
    rows = rows.persist()
    try:
        kinds = [r["label"] for r in rows.select("label").distinct().collect()]
        if len(kinds) < 2:
            return Forest([], *kinds)
        model = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed).fit(rows)
    finally:
        rows.unpersist()
    return Forest([_arrays(t.toDebugString) for t in model.trees])


def scan_secrets(docs: DataFrame, lexicon: Lexicon, forest: Forest, *, text: str, least_vote: float = 0.5,
                 mark: str = "[secret]", name: str = "secret") -> DataFrame:
    """All columns of `docs`, secrets in `text` replaced by `mark`, with `<name>_candidates` (count) and
    `<name>_spans` (first character and length in the text as it was, vote)."""
    shared = docs.sparkSession.sparkContext.broadcast((lexicon, forest))
    column = tw.place_of(docs, text)
    tw.refuse_names(docs, f"{name}_candidates", f"{name}_spans")
    spans_type = pa.list_(pa.struct([("first", pa.int32()), ("length", pa.int32()), ("vote", pa.float64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon, forest = shared.value
        for batch in batches:
            for piece in tw.pieces(tw.texts_of(batch.column(column).cast(pa.string()))):
                n = len(piece)
                rows, starts, ends, announced = _candidates(piece)
                around = [_context(piece, r, a, b) for r, a, b in zip(rows.tolist(), starts.tolist(), ends.tolist())]
                x = np.array([describe(*c, lexicon) for c in around]).reshape(-1, len(FEATURES))
                sure = np.array([KNOWN.fullmatch(c[0]) is not None for c in around], bool)
                place = np.array([evidence(c[0], c[1], a) for c, a in zip(around, announced.tolist())], np.int64)
                vote = np.where(sure, 1.0, forest.votes(x))
                own = batch.column(column).slice(piece.first, n)
                spans: list[list] = [[] for _ in range(n)]
                hit = sure | (vote >= np.minimum(least_vote * VOTES[place], 1.0))
                if hit.any():
                    texts = own.to_pylist()
                    for r in np.unique(rows[hit]).tolist():
                        body, low, out, last = piece.bytes_of(r), int(piece.bounds[r]), [], 0
                        for i in np.flatnonzero(hit & (rows == r)).tolist():
                            a, b = int(starts[i]) - low, int(ends[i]) - low
                            out += [body[last:a], mark.encode()]
                            last = b
                            spans[r].append({"first": len(body[:a].decode()), "length": len(body[a:b].decode()), "vote": float(vote[i])})
                        texts[r] = b"".join([*out, body[last:]]).decode()
                    own = pa.array(texts, batch.column(column).type)
                columns = [c.slice(piece.first, n) for c in batch.columns]
                columns[column] = own
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(np.bincount(rows, minlength=n)), pa.array(spans, spans_type)],
                    [*batch.schema.names, f"{name}_candidates", f"{name}_spans"])

    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(scan, f"{own}, `{name}_candidates` long, "
                                 f"`{name}_spans` array<struct<first:int,length:int,vote:double>>")
