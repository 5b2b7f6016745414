"""Secrets in texts: fixed patterns, and a battery of randomness tests on encoded tokens.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from plotwise.llm.spark import stored

# The base patterns.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"  # a run is taken whole, so a shorter one never holds a match
KINDS = ("assign", "access", "hex", "random")

# The alphabets a token may be written in, each before those that contain it.
ALPHABETS = {
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "BASE36": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base62": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}
LEAST_LENGTH = 24
TOKEN = r"[A-Za-z0-9+/_-]{24,}={0,2}"
PARTS = (r"[A-Za-z0-9_-]{24,}={0,2}", r"[A-Za-z0-9+/]{24,}={0,2}")
RATE = 0.05  # of false discoveries: random tokens discarded as ordinary ones
STEPS = 400  # p-values are counted in steps of a hundredth of a decade


def _matches(text: Column, pattern: str, group: int) -> Column:
    """start, end, matched text and a group's text of each leftmost match, in code points.

    The text between matches is what split() returns, so lengths add up to places.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.split(text, pattern, -1)
    zipped = F.transform(
        found,
        lambda m, i: F.struct(
            F.char_length(F.get(gaps, i)).alias("gap"), F.char_length(m).alias("long"), m.alias("token"), F.get(value, i).alias("value")
        ),
    )
    empty = F.array().cast("array<struct<start:int,end:int,token:string,value:string>>")
    placed = F.aggregate(
        zipped,
        F.struct(F.lit(0).alias("at"), empty.alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + x["long"]).alias("at"),
            F.concat(
                acc["out"],
                F.array(
                    F.struct(
                        (acc["at"] + x["gap"]).alias("start"),
                        (acc["at"] + x["gap"] + x["long"]).alias("end"),
                        x["token"].alias("token"),
                        x["value"].alias("value"),
                    )
                ),
            ).cast("array<struct<start:int,end:int,token:string,value:string>>"),
        ),
        lambda acc: acc["out"],
    )
    return F.when(F.regexp_like(text, F.lit(pattern)), placed).otherwise(empty)


def _fitting(candidates: Column) -> Column:
    """Candidates, those with signs of two alphabets cut at the signs of either.

    A key in a path (`/api-v1/keys/...`) is a run with slashes and hyphens, which no alphabet
    holds; its parts of enough length are candidates of their own.
    """

    def parts(c: Column) -> Column:
        cut = F.concat(*[_matches(c["token"], pattern, 0) for pattern in PARTS])
        placed = F.transform(
            cut,
            lambda p: F.struct(
                (c["start"] + p["start"]).alias("start"), (c["start"] + p["end"]).alias("end"),
                p["token"].alias("token"), p["value"].alias("value"),
            ),
        )
        mixed = F.regexp_like(c["token"], F.lit("[+/]")) & F.regexp_like(c["token"], F.lit("[_-]"))
        return F.when(mixed, placed).otherwise(F.array(c))

    return F.array_distinct(F.flatten(F.transform(candidates, parts)))


def _spans(matches: Column, kind: int) -> Column:
    return F.transform(
        matches, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end"))
    )


def said_spans(spans: Column) -> Column:
    """`kind:start:end` of each span, in order of start, kind and end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = F.transform(
        F.array_sort(spans),
        lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.array_join(one, ",")


def _normal_tail(z: Column) -> Column:
    """Upper tail of the normal distribution, within 0.0002."""
    return 1 / (1 + F.exp(F.least(z * 1.5976 + z * z * z * 0.07056, F.lit(600.0))))


def randomness(tokens: DataFrame) -> DataFrame:
    """Tokens with their inferred encoding, three p-values and the combined one.

    The encoding is the smallest alphabet that holds all characters. Under the hypothesis
    "drawn evenly from that alphabet": chi-squared over the alphabet's characters (upper
    tail, variance exact for the length), the number of runs above and below the middle of
    the alphabet, and lag-one serial correlation of the characters' places (both two-sided).
    Fisher's method combines them. All alphabets hold digits, so a word of letters alone is
    far from even in each of them.
    """
    body = F.regexp_replace("token", "=+$", "")
    encoding = F.coalesce(
        *[F.when(F.length(F.translate("body", chars, "")) == 0, F.lit(name)) for name, chars in ALPHABETS.items()]
    )
    alphabet = F.create_map(*[F.lit(x) for pair in ALPHABETS.items() for x in pair])
    n, k = F.col("n").cast("double"), F.col("k").cast("double")
    coded = (
        tokens.withColumn("body", body)
        .withColumn("encoding", encoding)
        .filter("encoding is not null")
        .withColumn("alphabet", alphabet[F.col("encoding")])
        .withColumn("n", F.length("body"))
        .withColumn("k", F.length("alphabet"))
        .withColumn("at", F.expr("transform(sequence(1, n), i -> instr(alphabet, substring(body, i, 1)) - 1)"))
        .withColumn(
            "squares",
            F.expr(
                "aggregate(array_distinct(at), 0D, (acc, c) -> acc + pow(size(filter(at, x -> x = c)), 2))"
            ),
        )
        .withColumn("above", F.expr("size(filter(at, x -> 2 * x >= k))").cast("double"))
        .withColumn(
            "runs",
            F.expr("1 + size(filter(sequence(1, n - 1), i -> (2 * at[i] >= k) <> (2 * at[i - 1] >= k)))").cast("double"),
        )
        .withColumn("mean", F.expr("aggregate(at, 0D, (acc, x) -> acc + x) / n"))
        .withColumn("spread", F.expr("aggregate(at, 0D, (acc, x) -> acc + pow(x - mean, 2))"))
        .withColumn(
            "lagged", F.expr("aggregate(sequence(1, n - 1), 0D, (acc, i) -> acc + (at[i] - mean) * (at[i - 1] - mean))")
        )
    )
    chi = F.col("squares") * k / n - n
    z_chi = (chi - (k - 1)) / F.sqrt(2 * (k - 1) * (1 - 1 / n))
    below = n - F.col("above")
    pairs = 2 * F.col("above") * below
    z_runs = (F.col("runs") - 1 - pairs / n) / F.sqrt(pairs * (pairs - n) / (n * n * (n - 1)))
    z_serial = F.col("lagged") / F.col("spread") * F.sqrt(n)
    one_sided = {"p_uniform": F.when(F.col("spread") > 0, _normal_tail(z_chi)).otherwise(0.0)}
    two_sided = {
        "p_runs": F.when(pairs > n, 2 * _normal_tail(F.abs(z_runs))).otherwise(0.0),
        "p_serial": F.when(F.col("spread") > 0, 2 * _normal_tail(F.abs(z_serial))).otherwise(0.0),
    }
    tested = coded.select(
        "token", "encoding", "n", *[F.greatest(p, F.lit(1e-30)).alias(name) for name, p in {**one_sided, **two_sided}.items()]
    )
    x = -(F.log("p_uniform") + F.log("p_runs") + F.log("p_serial"))
    return tested.withColumn("p", F.least(F.exp(-x) * (1 + x + x * x / 2), F.lit(1.0)))


def random_tokens(tokens: DataFrame, rate: float = RATE) -> DataFrame:
    """The distinct tokens whose randomness is not rejected; column token.

    Rejections are controlled at a false-discovery rate within each stratum of encoding and
    length (doubling steps): long tokens, whose tests are sharp, do not lend their evidence
    to short ones. Benjamini-Hochberg is applied to counts of p-values in steps of a
    hundredth of a decade, each taken at its upper end: a bounded table, and never a
    looser threshold than on the values themselves.
    """
    tested = randomness(tokens.select("token").distinct()).select(
        "token",
        "encoding",
        F.floor(F.log2(F.col("n"))).alias("length_class"),
        F.least(F.floor(-F.log10("p") * 100), F.lit(STEPS)).cast("int").alias("step"),
    )
    tested = stored(tested, "random-tested")
    stratum = ["encoding", "length_class"]
    counts = tested.groupBy(*stratum, "step").agg(F.count("*").alias("tokens"))
    as_small = Window.partitionBy(*stratum).orderBy(F.col("step").desc())
    share = F.sum("tokens").over(as_small) / F.sum("tokens").over(Window.partitionBy(*stratum))
    upper_end = F.pow(F.lit(10.0), -F.col("step") / 100)
    rejected = (
        counts.withColumn("passes", upper_end <= rate * share).groupBy(*stratum).agg(F.min(F.when(F.col("passes"), F.col("step"))).alias("limit"))
    )
    # every step at or beyond the limit is rejected
    return tested.join(rejected, stratum).filter("limit is null or step < limit").select("token")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rate: float = RATE) -> DataFrame:
    """One row per document: doc_id, spans (array of start, kind, end, value), in order.

    Base spans are leftmost non-overlapping per pattern, in code points, end exclusive. The
    battery adds spans of kind `random`: tokens of at least 24 characters, not touching a
    base span, whose randomness is not rejected. A run that mixes + or / with - or _ fits no
    alphabet: its parts between the one pair of signs and between the other are tested. Tokens are tested once each, over the whole
    corpus, so a token repeated in a third of the rows costs one test.

    A null or empty text has no spans; null ids are kept; rows repeating id and text get the
    same result each. Other columns are ignored. An empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    base = {
        0: F.filter(_matches(F.col("text"), ASSIGN, 2), lambda m: F.char_length(m["value"]) >= 6),
        1: F.filter(_matches(F.col("text"), ACCESS, 0), lambda m: F.char_length(m["token"]) >= 20),
        2: _matches(F.col("text"), HEX, 0),
    }
    found = rows.select(
        "doc_id",
        F.xxhash64("text").alias("text_key"),
        *[m.alias(f"m{k}") for k, m in base.items()],
        _matches(F.col("text"), TOKEN, 0).alias("candidates"),
    ).select(
        "doc_id",
        "text_key",
        F.array_sort(F.concat(*[_spans(F.col(f"m{k}"), k) for k in base])).alias("base"),
        "candidates",
    )
    found = found.withColumn("candidates", _fitting(F.col("candidates")))
    # a token inside an assignment has to be matched to it: tokens overlap base spans or not
    free = F.filter(
        "candidates",
        lambda c: ~F.exists("base", lambda b: (b["start"] < c["end"]) & (b["end"] > c["start"])),
    )
    found = stored(
        found.select("doc_id", "text_key", "base", F.transform(free, lambda c: c.dropFields("value")).alias("candidates")), "secrets"
    )
    each = found.select("doc_id", "text_key", F.explode("candidates").alias("c")).select(
        "doc_id", "text_key", F.col("c.start"), F.col("c.end"), F.col("c.token")
    )
    added = (
        each.join(random_tokens(each, rate), "token")
        .groupBy("doc_id", "text_key")
        .agg(
            F.collect_set(F.struct("start", F.lit(KINDS.index("random")).alias("kind"), "end")).alias("added")
        )
        .withColumnsRenamed({"doc_id": "id2", "text_key": "key2"})
    )
    same = F.col("doc_id").eqNullSafe(F.col("id2")) & (F.col("text_key") == F.col("key2"))
    both = F.array_sort(F.concat("base", F.coalesce("added", F.array().cast("array<struct<start:int,kind:int,end:int>>"))))
    return found.join(added, same, "left").select("doc_id", both.alias("spans"))
