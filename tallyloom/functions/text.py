"""Text expressions, n-grams and lexicon scoring."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.patterns import word_table
from tallyloom.functions.values import round_even

# Unit names of the formatted sizes and durations.
SIZE_UNITS = ("B", "KB", "MB", "GB", "TB")
DURATION_UNITS = {"second": "秒", "minute": "分", "hour": "小时", "minutes_after_hour": "分钟"}
NOT_STARTED = "未开始"

# Model file endings and upload prefixes that are not part of a name.
MODEL_FILE_ENDING = r"(?i)\.(pkl|pt|pth|h5|keras|onnx|joblib|zip)$"
UUID_PREFIX = r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}_"
HEX_PREFIX = r"(?i)^[0-9a-f]{32}_"

HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]]*\]|[^/:?#]*)"
SCHEME = r"^([a-zA-Z][a-zA-Z0-9+.-]*)://"
IPV4 = r"^(\d{1,3})\.(\d{1,3})\.(\d{1,3})\.(\d{1,3})$"

# Address ranges that are private, reserved, local or multicast.
BLOCKED_NETWORKS = (
    "0.0.0.0/8", "10.0.0.0/8", "100.64.0.0/10", "127.0.0.0/8", "169.254.0.0/16",
    "172.16.0.0/12", "192.0.0.0/24", "192.0.2.0/24", "192.168.0.0/16", "198.18.0.0/15",
    "198.51.100.0/24", "203.0.113.0/24", "224.0.0.0/4", "240.0.0.0/4",
)
BLOCKED_V6 = r"(?i)^\[(::1?|fc[0-9a-f]{2}:.*|fd[0-9a-f]{2}:.*|fe[89ab][0-9a-f]:.*|ff[0-9a-f]{2}:.*)\]$"


def format_bytes(size: Column) -> Column:
    """1024 steps with two decimals (ties to even); zero is `0 B`."""
    out = F.lit(None).cast("string")
    for i in reversed(range(len(SIZE_UNITS))):
        scaled = round_even(size / F.lit(float(1024 ** i)), 2)
        text = F.format_string(f"%.2f {SIZE_UNITS[i]}", scaled)
        out = text if i == len(SIZE_UNITS) - 1 else F.when(size < 1024 ** (i + 1), text).otherwise(out)
    return F.when(size == 0, "0 B").otherwise(out)


def format_duration(seconds: Column, units: Mapping[str, str] = DURATION_UNITS) -> Column:
    """Seconds; minutes and seconds; hours and minutes."""
    whole = lambda c: F.floor(c).cast("string")
    return (F.when(seconds < 60, F.concat(whole(seconds), F.lit(units["second"])))
            .when(seconds < 3600, F.concat(whole(seconds / 60), F.lit(units["minute"]),
                                           whole(seconds % 60), F.lit(units["second"])))
            .when(seconds.isNotNull(), F.concat(
                whole(seconds / 3600), F.lit(units["hour"]),
                whole((seconds % 3600) / 60), F.lit(units["minutes_after_hour"]))))


def format_datetime(ts: Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.coalesce(F.date_format(ts, pattern), F.lit("-"))


def truncate_text(text: Column, limit: int = 100, suffix: str = "...") -> Column:
    """At most `limit` characters, the suffix counted; null becomes empty."""
    return (F.when(text.isNull(), "").when(F.length(text) <= limit, text)
            .otherwise(F.concat(F.substring(text, 1, limit - len(suffix)), F.lit(suffix))))


def slug(name: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(name), r"[^a-zA-Z0-9_-]", "-"), r"^-+|-+$", "")


def clean_filename(name: Column) -> Column:
    """Readable name: no ending, no upload prefix, separators as spaces."""
    out = F.regexp_replace(name, MODEL_FILE_ENDING, "")
    out = F.regexp_replace(F.regexp_replace(out, UUID_PREFIX, ""), HEX_PREFIX, "")
    out = F.trim(F.translate(out, "_-", "  "))
    return F.when(F.length(out) >= 2, out)


def lookup(key: Column, mapping: Mapping[str, str], default: Column | None = None) -> Column:
    """Literal map lookup with a default."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    found = F.create_map(*pairs)[key] if pairs else F.lit(None).cast("string")
    return F.coalesce(found, default) if default is not None else found


def extract_algorithm(name: Column, tail: str, known: Mapping[str, str], prefixes: Sequence[tuple[str, str]]) -> Column:
    """First group of the pattern `tail` looked up in `known`, else the first prefix contained."""
    tail = F.regexp_extract(name, tail, 1)
    out = F.lit(None).cast("string")
    for prefix, algo in reversed(prefixes):
        out = F.when(name.contains(prefix), algo).otherwise(out)
    return F.coalesce(lookup(tail, known), out)


def normalise_key(key: Column, aliases: Mapping[str, str], canonical: Sequence[str] = ()) -> Column:
    """Lower case, `-` to `_`; canonical keys stay, aliases map, others stay."""
    k = F.translate(F.lower(key), "-", "_")
    return F.when(key.isNull(), "").when(k.isin(*canonical), k).otherwise(lookup(k, aliases, k))


def strip_html(text: Column, limit: int | None = None) -> Column:
    """Remove tags and trim; with `limit`, keep at most so many characters (a stored-length rule)."""
    bare = F.regexp_replace(F.regexp_replace(text, r"<[^>]*>", ""), r"^\s+|\s+$", "")
    return bare if limit is None else F.substring(bare, 1, limit)


def moderate(text: Column, patterns: Sequence[str]) -> Column:
    """Null when clean, else `empty_content` or the first banned pattern."""
    out = F.lit(None).cast("string")
    for p in reversed(patterns):
        out = F.when(text.rlike(f"(?i){p}"), F.lit(f"auto_filtered:{p}")).otherwise(out)
    return F.when(text.isNull() | text.rlike(r"^\s*$"), "empty_content").otherwise(out)


def host_of(url: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(url, HOST, 1)), F.lit(""))


def link_allowed(url: Column, sites: Sequence[str]) -> Column:
    """Host is one of `sites` or below one of them."""
    host = host_of(url)
    return F.coalesce(reduce(Column.__or__, [(host == s) | host.endswith("." + s) for s in sites]),
                      F.lit(False))


def ipv4_number(host: Column) -> Column:
    """Literal IPv4 address as a number, null for anything else."""
    octets = [F.regexp_extract(host, IPV4, i).try_cast("long") for i in range(1, 5)]
    valid = reduce(Column.__and__, [o <= 255 for o in octets])
    return F.when(valid, octets[0] * 16777216 + octets[1] * 65536 + octets[2] * 256 + octets[3])


def url_admissible(url: Column, allow_local: bool = False,
                   networks: Sequence[str] = BLOCKED_NETWORKS) -> Column:
    """http(s), a host, and no literal address in a blocked network."""
    host = host_of(url)
    address = ipv4_number(host)
    blocked = F.lit(False)
    for net in networks:
        base, bits = net.split("/")
        parts = [int(x) for x in base.split(".")]
        low = parts[0] * 16777216 + parts[1] * 65536 + parts[2] * 256 + parts[3]
        blocked = blocked | address.between(low, low + 2 ** (32 - int(bits)) - 1)
    blocked = F.coalesce(blocked, F.lit(False)) | host.rlike(BLOCKED_V6)
    if allow_local:
        blocked = blocked & ~host.isin("localhost", "127.0.0.1")
    scheme = F.lower(F.regexp_extract(url, SCHEME, 1))
    return F.coalesce(scheme.isin("http", "https") & host.isNotNull() & ~blocked, F.lit(False))


# Fixed value: a window never starts inside a surrogate pair.
WHOLE = r"(?s)(?![\x{DC00}-\x{DFFF}])"


def char_ngrams(text: Column, width: int) -> Column:
    """All overlapping character windows of one width, in order."""
    return F.regexp_extract_all(text, F.lit(f"{WHOLE}(?=(.{{{width}}}))"), F.lit(1))


def ngram_array(text: Column, widths: Sequence[int] = (2, 3, 4)) -> Column:
    return F.concat(*[char_ngrams(text, w) for w in widths])


def mixed_tokens(text: Column) -> Column:
    """Word tokens (letters/digits/underscore of any script but CJK), then every
    CJK character as its own token."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{M}\p{N}_&&[^㐀-鿿]]+"), F.lit(0))
    return F.concat(words, F.regexp_extract_all(text, F.lit(r"[㐀-鿿]"), F.lit(0)))


def lexicon_hits(df: DataFrame, key: str, text: str, lexicon: DataFrame, word: str, weight: str,
                 widths: Sequence[int] = (2, 3, 4)) -> DataFrame:
    """Hits and weighted score per (row, lexicon word), overlapping occurrences included. The texts are read once."""
    found = word_table(df, key, text, lexicon, word, widths)
    return (found.join(lexicon, word).groupBy(key, word)
            .agg(F.sum("hits").alias("hits"), F.sum(F.col("hits") * F.col(weight)).alias("score")))


def lexicon_sentiment(df: DataFrame, key: str, text: str, lexicon: DataFrame, word: str, weight: str,
                      negators: Sequence[str], widths: Sequence[int] = (1, 2, 3, 4),
                      labels: tuple[str, str, str] = ("positive", "negative", "neutral")) -> DataFrame:
    """Label texts by lexicon hits; a negator flips a hit.

    A hit is flipped when a negator occurs in the three characters before the
    word's first occurrence, or when one of the two windows before the hit is
    itself a negator. The texts are read once, and only hits leave them.
    """
    body = F.regexp_replace(F.col(text), r"^\s+|\s+$", "")
    found = word_table(df.select(key, body.alias("__t")), key, "__t", lexicon, word, widths, negators)
    per_word = found.join(lexicon, word).groupBy(key, word, weight).agg(
        F.sum("hits").alias("hits"), F.sum("near").alias("near"), F.min_by("prefix", "pos").alias("prefix"))
    flipped = F.lit(False)
    for n in negators:
        flipped = flipped | F.col("prefix").contains(n)
    turned = F.when(flipped, F.col("hits")).otherwise(F.col("near"))
    kept = F.col("hits") - turned
    good = F.col(weight) > 0
    scores = per_word.groupBy(key).agg(
        F.sum(F.when(good, kept).otherwise(turned)).alias("positive_count"),
        F.sum(F.when(good, turned).otherwise(kept)).alias("negative_count"))
    p, n = F.coalesce("positive_count", F.lit(0)), F.coalesce("negative_count", F.lit(0))
    return (df.select(key).join(scores, key, "left")
            .select(key, p.alias("positive_count"), n.alias("negative_count"))
            .select("*",
                    F.when(F.col("positive_count") > F.col("negative_count"), labels[0])
                    .when(F.col("negative_count") > F.col("positive_count"), labels[1])
                    .otherwise(labels[2]).alias("label"),
                    F.when(F.col("positive_count") + F.col("negative_count") == 0, 0.0)
                    .when(F.col("positive_count") == F.col("negative_count"), 0.5)
                    .otherwise(round_even(F.greatest("positive_count", "negative_count")
                                          / (F.col("positive_count") + F.col("negative_count")), 3))
                    .alias("confidence")))


def keyword_class(text: Column, classes: Sequence[str]) -> tuple[Column, Column]:
    """(class, probability per class): name contained scores 1, a word of the
    text contained in the name 0.5; the first best wins, capped at 0.5 and the
    rest shared by the other classes. No hit gives null."""
    low = F.lower(text)
    words = F.filter(F.split(low, r"\s+"), lambda w: F.length(w) > 1)

    def score(name: str) -> Column:
        inside = F.exists(words, lambda w: F.instr(F.lit(name), w) > 0) & F.lit(len(name) > 1)
        return F.when(low.contains(name), 1.0).when(inside, 0.5).otherwise(0.0)

    scores = [score(c.lower()) for c in classes]
    top = F.greatest(*scores) if len(scores) > 1 else scores[0]
    best = F.lit(None).cast("string")
    for c, s in reversed(list(zip(classes, scores))):
        best = F.when((s == top) & (top > 0), F.lit(c)).otherwise(best)
    share = F.round(F.lit(0.5 / max(1, len(classes) - 1)), 3)
    probs = F.array(*[F.when(best == c, 0.5).otherwise(share) for c in classes])
    return best, F.when(best.isNotNull(), probs)


def domain_by_hits(text: Column, domains: Sequence[tuple[str, Sequence[str]]]) -> Column:
    """Domain with most distinct keywords contained; first wins ties; none is null."""
    low = F.lower(text)
    scores = [reduce(Column.__add__, [F.when(low.contains(k.lower()), 1).otherwise(0) for k in words])
              for _, words in domains]
    top = F.greatest(*scores) if len(scores) > 1 else scores[0]
    out = F.lit(None).cast("string")
    for (name, _), s in reversed(list(zip(domains, scores))):
        out = F.when((s == top) & (s > 0), name).otherwise(out)
    return out


def split_tags(tags: Column) -> Column:
    return F.filter(F.transform(F.split(F.coalesce(tags, F.lit("")), ","), lambda t: F.trim(t)), lambda t: t != "")


def join_tags(tags: Column) -> Column:
    return F.nullif(F.array_join(tags, ","), F.lit(""))


def tail_lines(text: Column, n: int = 50) -> Column:
    lines = F.split(F.regexp_replace(F.coalesce(text, F.lit("")), r"^\s+|\s+$", ""), "\n")
    return F.array_join(F.slice(lines, F.greatest(F.lit(1), F.size(lines) - n + 1), n), "\n")
