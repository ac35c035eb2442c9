"""Quality rules under weak supervision: rules vote or abstain, EM weighs them, a posterior decides.

Each rule looks at a few counts of a text and votes good, bad or abstains. No labels are used: the
accuracies of the rules follow from how often they agree over the whole corpus. All texts with the
same votes are alike to the model, so it is fitted on one row per pattern of votes (at most
3 ** number of rules, whatever the corpus), and applied by a look-up of the pattern.

Defined results: a null text has no words and no lines; repeated rows are judged alike, each on its
own; an empty table gives an empty result; columns outside ``carry`` are not looked at. Texts are looked at
whole; a text and its windows of words must fit in a task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vintage.llm.staging import inline, packed, stage
from vintage.llm.text import whole, words

WINDOW = 5
GOOD, BAD, ABSTAIN = "+", "-", "0"
MIN_WORDS = 10
#: Chances of a vote for bad to start from: as noise, and on the bad texts that a rule is made for; and the least of those.
START_GOOD, START_OWN, LEAST_OWN = 0.01, 0.9, 0.5
MAX_REPEATED_PERCENT = 20


def _per(count: str, total: str) -> Column:
    return F.col(count) / F.greatest(F.col(total), F.lit(1))


def rules() -> dict[str, tuple[Column, Column]]:
    """Name -> (votes bad, votes good) over the counts; neither: abstains. Bad wins over good."""
    chars = _per("word_chars", "n_words")
    return {
        "length": (F.col("n_words") < MIN_WORDS, F.col("n_words") >= 40),
        "word_length": ((chars < 2) | (chars > 16), chars.between(3, 10)),
        "symbols": (_per("n_symbols", "n_words") > 0.2, _per("n_symbols", "n_words") < 0.03),
        "shouting": (_per("n_caps", "n_words") > 0.4, _per("n_caps", "n_words") < 0.05),
        "marks": (_per("n_marks", "n_words") > 0.25, _per("n_marks", "n_words") < 0.03),
        "lines": (_per("n_dup_lines", "n_lines") > 0.5, F.col("n_dup_lines") == 0),
        "repeats": (_per("n_repeat_words", "n_words") > 0.3, _per("n_repeat_words", "n_words") < 0.1),
        "variety": (_per("n_distinct", "n_words") < 0.15, _per("n_distinct", "n_words") > 0.3),
        "symbol_runs": (_per("n_symbol_runs", "n_words") > 0.1, _per("n_symbol_runs", "n_words") < 0.02),
        "sentences": (_per("n_stops", "n_words") < 0.08, _per("n_stops", "n_words").between(0.08, 0.2)),
        "short_words": (chars < 5, chars.between(5, 10)),
    }


#: Rules that look for the same fault. Votes of one family support each other, of others they are unrelated.
FAMILIES = {
    "length": "shape", "word_length": "shape", "symbols": "symbols", "symbol_runs": "symbols", "short_words": "symbols",
    "shouting": "shouting", "marks": "shouting",
    "lines": "repetition", "repeats": "repetition", "variety": "repetition", "sentences": "repetition",
}


def counted(df: DataFrame, text: Column, carry: Column) -> DataFrame:
    """One row per row of ``df``: ``carry`` as ``row`` and the counts that the rules look at."""
    base = df.select(carry.alias("row"), whole(text).alias("text"))
    split = base.select(
        "row",
        "text",
        words(F.col("text")).alias("words"),
        F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
    )
    hashed = split.select(
        "row",
        "words",
        F.size("words").alias("n"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count("text", F.lit(r"\p{Lu}{2,}")).cast("long").alias("n_caps"),
        F.regexp_count("text", F.lit(r"[!?]")).cast("long").alias("n_marks"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]+")).cast("long").alias("n_symbol_runs"),
        F.regexp_count("text", F.lit(r"[.!?]")).cast("long").alias("n_stops"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"),
    )
    starts = F.when(F.col("n") >= WINDOW, F.sequence(F.lit(0), F.col("n") - WINDOW)).otherwise(
        F.array().cast("array<int>")
    )
    windows = hashed.select(
        "*",
        F.size(F.array_distinct("hashes")).cast("long").alias("n_distinct"),
        F.transform(starts, lambda i: F.xxhash64(F.slice("hashes", i + 1, WINDOW))).alias("windows"),
    )
    # Different hashes prove all windows different. Otherwise the windows themselves are compared.
    suspect = windows.withColumn(
        "sorted",
        F.when(
            F.size("windows") > F.size(F.array_distinct("windows")),
            F.sort_array(
                F.transform(
                    F.sequence(F.lit(0), F.col("n") - WINDOW),
                    lambda i: F.struct(F.array_join(F.slice("words", i + 1, WINDOW), " ").alias("w"), i.alias("i")),
                )
            ),
        ),
    ).drop("words", "hashes", "windows")
    text_at = lambda j: F.get(F.col("sorted"), j)["w"]
    found = suspect.withColumn(
        "places",
        F.sort_array(
            F.transform(
                F.filter(
                    F.transform(
                        "sorted",
                        lambda x, j: F.struct(
                            x["i"].alias("i"),
                            (
                                F.coalesce(text_at(j - 1) == x["w"], F.lit(False))
                                | F.coalesce(text_at(j + 1) == x["w"], F.lit(False))
                            ).alias("twice"),
                        ),
                    ),
                    lambda x: x["twice"],
                ),
                lambda x: x["i"],
            )
        ),
    ).drop("sorted")
    covered = F.aggregate(
        F.transform(
            "places",
            lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(F.col("places"), j + 1) - p, F.lit(WINDOW))),
        ),
        F.lit(0).cast("long"),
        lambda total, x: total + x,
    )
    return found.select(
        "row",
        F.col("n").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        "n_lines",
        "n_caps",
        "n_marks",
        "n_distinct",
        "n_symbol_runs",
        "n_stops",
    )


def votes() -> Column:
    """The votes of all rules as one string, a character per rule."""
    return F.concat(*(F.when(bad, BAD).when(good, GOOD).otherwise(ABSTAIN) for bad, good in rules().values()))


def fit(
    patterns: dict[str, int], families: list[str] | None = None, rounds: int = 200, strength: float = 10.0
) -> dict[str, float]:
    """EM over vote patterns: the posterior chance of being good of each.

    Besides the good texts there is a class of bad texts per family of rules (by default ``FAMILIES``), as most
    bad texts are bad in one way; a family of one rule, which no other could confirm, has none. A rule has two
    error rates: how often it misses its family's class, and how often it votes bad on others, its noise. Noise is
    taken to be the same on good texts as on texts that are bad in an unrelated way, and it is there, where
    other rules have given a text away, that it is estimated. So a rule that cries bad at random is overruled
    on good texts, and one that is quiet on other faults is believed even alone. ``strength`` pseudo votes,
    which hold a rule to be accurate, decide where there is no such evidence. An abstention says nothing.
    """
    families = families or [FAMILIES.get(name, name) for name in rules()]
    names = sorted(f for f in set(families) if families.count(f) > 1)
    own_class = [1 + names.index(f) if f in names else 0 for f in families]
    n, classes = len(families), 1 + len(names)
    # Noise starts from texts that two rules of another family agree on.
    noise, own = [], [START_OWN] * n
    for j, mine in enumerate(own_class):
        said, bad = 0.0, 0.0
        for pattern, count in patterns.items():
            agreed = [c for c in range(1, classes) if c != mine and sum(v == BAD and own_class[k] == c for k, v in enumerate(pattern)) > 1]
            said += count * (bool(agreed) and pattern[j] != ABSTAIN)
            bad += count * (bool(agreed) and pattern[j] == BAD)
        noise.append((bad + strength * START_GOOD) / (said + strength))
    share = [0.5, *[0.5 / max(len(names), 1)] * len(names)]
    total = sum(patterns.values())
    for _ in range(rounds if total else 0):
        mass = [0.0] * classes
        voted, against = ([[0.0] * n for _ in range(classes)] for _ in range(2))
        for pattern, count in sorted(patterns.items()):
            for c, p in enumerate(_posteriors(share, noise, own, own_class, pattern)):
                mass[c] += count * p
                for j, vote in enumerate(pattern):
                    if vote != ABSTAIN:
                        voted[c][j] += count * p
                        against[c][j] += count * p * (vote == BAD)
        before = [*share, *noise, *own]
        share = [(m + strength / classes) / (total + strength) for m in mass]
        for j, mine in enumerate(own_class):
            unrelated = [c for c in range(1, classes) if c != mine]
            said, bad = sum(voted[c][j] for c in unrelated), sum(against[c][j] for c in unrelated)
            noise[j] = (bad + strength * START_GOOD) / (said + strength)
            # A class stands for its rules.
            if mine:
                own[j] = max((against[mine][j] + strength * START_OWN) / (voted[mine][j] + strength), LEAST_OWN)
        if max(abs(x - y) for x, y in zip(before, [*share, *noise, *own], strict=True)) < 1e-9:
            break
    return {pattern: _posteriors(share, noise, own, own_class, pattern)[0] for pattern in patterns}


def _posteriors(share: list[float], noise: list[float], own: list[float], own_class: list[int], pattern: str) -> list[float]:
    logs = [math.log(s) for s in share]
    for j, vote in enumerate(pattern):
        if vote != ABSTAIN:
            for c in range(len(logs)):
                p = own[j] if c and own_class[j] == c else noise[j]
                logs[c] += math.log(p if vote == BAD else 1 - p)
    top = max(logs)
    weights = [math.exp(x - top) for x in logs]
    return [w / sum(weights) for w in weights]


def judge(df: DataFrame, carry: list[str], text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The ``carry`` columns as ``row``, the counts, ``p_good``, ``base_failed`` and ``kept`` per row of ``df``."""
    table = stage(counted(df, F.col(f"`{text}`"), packed(df, carry)).withColumn("votes", votes()), "zstd")
    patterns = {r["votes"]: r["count"] for r in table.groupBy("votes").count().collect()}
    posterior = inline(df.sparkSession, "of, p_good", sorted(fit(patterns).items()) or [("", 0.0)])
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    return (
        table.join(F.broadcast(posterior), F.col("votes") == F.col("of"))
        .drop("of")
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= threshold))
    )


def kept_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns."""
    return judge(docs, docs.columns, text).filter("kept").select("row.*")
