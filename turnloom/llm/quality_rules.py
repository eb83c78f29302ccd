"""Quality by weak supervision: rules vote good, bad or abstain; EM estimates how accurate each rule is.

Each document gets the posterior probability of being good, given its rules' votes; the rules need not all pass. The
model: a document is good with a prior probability, and a rule that votes is right with one probability on good
documents and another on bad ones. Expectation-maximisation fits these numbers to the counts of vote patterns. There are at most 3^rules patterns, whatever
the corpus, and their counts cover all documents: one aggregation with partial sums, then each
round of the fit is an aggregation of the small table of patterns.

Everything is DataFrame and SQL expressions.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from turnloom.llm.shared import WORD_CHARACTER, held, stored, words

#: Rules, as name: (condition for good, condition for bad); neither: the rule abstains. Columns are those of measured().
RULES: dict[str, tuple[str, str]] = {
    "length": ("n_words >= 80", "n_words < 50"),
    "word_length": ("word_chars BETWEEN 3 * n_words AND 9 * n_words", "word_chars < 2 * n_words OR word_chars > 14 * n_words"),
    "symbols": ("50 * n_symbols <= n_words", "10 * n_symbols > n_words"),
    "lines": ("10 * n_dup_lines <= n_lines", "10 * n_dup_lines > 3 * n_lines"),
    "repetition": ("10 * n_repeat_words <= n_words", "10 * n_repeat_words > 3 * n_words"),
    "letters": ("100 * n_letters >= 92 * word_chars", "100 * n_letters < 88 * word_chars"),
    "capitals": ("10 * n_capitals <= 2 * n_letters", "10 * n_capitals > 5 * n_letters"),
}
#: The fit: rounds of expectation-maximisation, and what it starts from: the share of good documents, and how often a
#: rule that votes is right on a good and on a bad document. SMOOTHING imagined votes like that smooth each accuracy.
ROUNDS, START_PRIOR, START_GOOD, START_BAD, SMOOTHING = 25, 0.8, 0.9, 0.4, 2.0
#: Bounds of the fitted numbers: no rule decides alone, and none is turned round (a good vote never counts against).
LEAST, MOST = 0.02, 0.98
#: The fit ends when no number moves more than this.
SETTLED = 1e-3
THRESHOLD = 0.5
#: Too short, or mostly repeated words: rejected whatever the rules say.
BASE_FAILED = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_capitals")


def _free(names: list[str], taken: list[str]) -> list[str]:
    """The names, with as many underscores behind as it takes for none to be taken."""
    while {n.lower() for n in names} & {t.lower() for t in taken}:
        names = [n + "_" for n in names]
    return names


def measured(docs: DataFrame, text: str, names: list[str]) -> DataFrame:
    """docs with a column more for each of MEASURES, under the given names.

    n_words, word_chars (code points in words), n_symbols, n_dup_lines (lines with a word that equal an earlier one),
    n_repeat_words (words in three-word windows that the text has twice or more), n_lines (with a word), n_letters,
    n_capitals. A null text has none of all.
    """
    w, lines, windows, twice, places = _free(["_words", "_lines", "_windows", "_twice", "_places"], docs.columns)
    body = F.coalesce(F.col(text), F.lit(""))
    df = docs.withColumns({w: words(F.col(text)), lines: F.filter(F.split(body, "\n"), lambda x: x.rlike(WORD_CHARACTER))})
    rolled = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")))
    df = df.withColumn(windows, F.when(F.size(w) >= 3, F.sort_array(rolled)))
    # of windows in the order of their hashes, those that a neighbour equals
    df = df.withColumn(twice, F.filter(windows, lambda x, k: F.get(windows, k - 1)["h"].eqNullSafe(x["h"]) | F.get(windows, k + 1)["h"].eqNullSafe(x["h"])))
    df = df.withColumn(places, F.sort_array(F.transform(twice, lambda x: x["i"])))
    start = F.struct(F.lit(0).alias("covered"), F.lit(-3).alias("last"))
    covered = F.aggregate(places, start, lambda a, i: F.struct((a["covered"] + F.least(F.lit(3), i - a["last"])).alias("covered"), i.alias("last")), lambda a: a["covered"])
    measures = [
        F.size(w), F.length(F.array_join(w, "")), F.regexp_count(body, F.lit("[#*$%&|<>]")), F.size(lines) - F.size(F.array_distinct(lines)), F.coalesce(covered, F.lit(0)),
        F.size(lines), F.length(F.regexp_replace(body, r"[^\p{L}]+", "")), F.length(F.regexp_replace(body, r"[^\p{Lu}]+", "")),
    ]
    return df.withColumns({n: held(m.cast("long")) for n, m in zip(names, measures, strict=True)}).drop(w, lines, windows, twice, places)


def _over(names: list[str], condition: str) -> Column:
    """A condition over MEASURES as one over columns of the given names."""
    column = dict(zip(MEASURES, names, strict=True))
    return F.expr(re.sub(r"\b(" + "|".join(MEASURES) + r")\b", lambda m: f"`{column[m[1]]}`", condition))


def votes(names: list[str], rules: dict[str, tuple[str, str]] = RULES) -> Column:
    """An array of one vote per rule over the measures in columns of the given names: 1 good, -1 bad, 0 abstains."""
    return F.array(*[F.when(_over(names, good), 1).when(_over(names, bad), -1).otherwise(0) for good, bad in rules.values()])


@dataclass(frozen=True)
class Fit:
    """The fitted numbers: the share of good documents, and each rule's accuracy on good and on bad ones."""

    prior: float
    good: tuple[float, ...]
    bad: tuple[float, ...]

    def posterior(self, votes: Column) -> Column:
        """The probability of being good, given the votes."""
        odds = F.lit(log(self.prior / (1 - self.prior)))
        for j, (good, bad) in enumerate(zip(self.good, self.bad, strict=True)):
            vote = F.get(votes, F.lit(j))
            odds = odds + F.when(vote == 1, log(good / (1 - bad))).when(vote == -1, log((1 - good) / bad)).otherwise(0.0)
        return 1 / (1 + F.exp(-odds))


def fit(patterns: DataFrame, many: int, rounds: int = ROUNDS) -> Fit:
    """Expectation-maximisation over a table of vote patterns (votes, n). A round is one aggregation over the patterns."""
    state = Fit(START_PRIOR, (START_GOOD,) * many, (START_BAD,) * many)

    def bounded(p: float) -> float:
        return max(LEAST, min(MOST, p))

    for _ in range(rounds):
        good = F.col("n") * state.posterior(F.col("votes"))
        bad = F.col("n") - good
        vote = [F.get("votes", F.lit(j)) for j in range(many)]
        sums = [F.sum(F.col("n")).alias("n"), F.sum(good).alias("good")]
        for j, v in enumerate(vote):
            sums += [F.sum(F.when(v == 1, good)).alias(f"good_right_{j}"), F.sum(F.when(v != 0, good)).alias(f"good_cast_{j}")]
            sums += [F.sum(F.when(v == -1, bad)).alias(f"bad_right_{j}"), F.sum(F.when(v != 0, bad)).alias(f"bad_cast_{j}")]
        row = {k: float(v or 0) for k, v in patterns.agg(*sums).first().asDict().items()}

        def share(kind: str, j: int, start: float) -> float:
            return bounded((row[f"{kind}_right_{j}"] + SMOOTHING * start) / (row[f"{kind}_cast_{j}"] + SMOOTHING))  # noqa: B023

        right = tuple(share("good", j, START_GOOD) for j in range(many))
        wrong = tuple(max(share("bad", j, START_BAD), 1 - g) for j, g in enumerate(right))
        new = Fit(bounded(row["good"] / row["n"]) if row["n"] else START_PRIOR, right, wrong)
        moved = max(abs(x - y) for x, y in zip((new.prior, *new.good, *new.bad), (state.prior, *state.good, *state.bad), strict=True))
        state = new
        if moved < SETTLED:
            break
    return state


def judged(docs: DataFrame, *, text_col: str = "text", rules: dict[str, tuple[str, str]] = RULES, threshold: float = THRESHOLD, columns: list[str] | None = None) -> DataFrame:
    """docs (or only some of its columns) with one more column, a struct named ``verdict`` (or with underscores behind, if that is taken).

    It has the MEASURES, base_failed, votes, posterior (probability of being good) and kept: not base_failed, and the
    posterior at least the threshold. The measures are taken once and stored with those columns, for the fit and the verdicts; only
    the counts of vote patterns are shuffled, and one row of sums per round comes to the driver.

    Defined results: a null or empty text has no words, so it is base_failed; repeated rows count and are judged as
    often as they occur; whole texts count; with an empty table the fit stays at its start; other columns stay as they are.
    """
    # columns of their own: Spark would write the fields of a struct out wherever they are used, and evaluate them as often
    *names, ballot = _free([f"_{m}" for m in MEASURES] + ["_votes"], docs.columns)
    (verdict,) = _free(["verdict"], docs.columns)
    kept_columns = docs.columns if columns is None else columns
    marked = stored(measured(docs, text_col, names).withColumn(ballot, votes(names, rules)).select(*kept_columns, *names, ballot), "measured")
    patterns = marked.groupBy(F.col(ballot).alias("votes")).agg(F.count(F.lit(1)).alias("n"))
    fitted = fit(stored(patterns, "vote-patterns"), len(rules))
    failed, posterior = _over(names, BASE_FAILED), fitted.posterior(F.col(ballot))
    fields = [F.col(n).alias(m) for n, m in zip(names, MEASURES, strict=True)]
    verdicts = F.struct(*fields, failed.alias("base_failed"), F.col(ballot).alias("votes"), posterior.alias("posterior"), (~failed & (posterior >= threshold)).alias("kept"))
    return marked.withColumn(verdict, verdicts).drop(*names, ballot)


def kept(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """The documents that judged() keeps, all columns as they were."""
    found = judged(docs, text_col=text_col)
    return found.where(F.col(found.columns[-1])["kept"]).select(*docs.columns)


def sql(rules: dict[str, tuple[str, str]] = RULES, rounds: int = ROUNDS, threshold: float = THRESHOLD) -> str:
    """DuckDB SQL for doc_id, the first five of MEASURES, base_failed and kept over documents; the fit is a recursive query."""
    many = range(1, len(rules) + 1)
    word = r"[^\x20\x09-\x0D]+"
    bounded = lambda x: f"greatest({LEAST}, least({MOST}, {x}))"
    good = " * ".join(f"CASE votes[{j}] WHEN 1 THEN good[{j}] WHEN -1 THEN 1 - good[{j}] ELSE 1 END" for j in many)
    bad = " * ".join(f"CASE votes[{j}] WHEN 1 THEN 1 - bad[{j}] WHEN -1 THEN bad[{j}] ELSE 1 END" for j in many)
    share = lambda vote, mass, j, start: bounded(f"(sum(CASE WHEN votes[{j}] = {vote} THEN {mass} ELSE 0 END) + {SMOOTHING * start}) / (sum(CASE WHEN votes[{j}] <> 0 THEN {mass} ELSE 0 END) + {SMOOTHING})")
    moved = ", ".join(["abs(prior - was)", *(f"abs(good[{j}] - old_good[{j}]), abs(bad[{j}] - old_bad[{j}])" for j in many)])
    return f"""
WITH RECURSIVE split AS (
  SELECT doc_id, coalesce(text, '') AS body, regexp_extract_all(coalesce(text, ''), '{word}') AS words, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{word}')) AS lines FROM documents
), windows AS (
  SELECT doc_id, i, concat(words[i], ' ', words[i + 1], ' ', words[i + 2]) AS three FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM split)
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, three) AS times FROM windows), (SELECT unnest([0, 1, 2]) AS k) WHERE times > 1 GROUP BY doc_id
), measures AS (
  SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars, len(regexp_extract_all(body, '[#*$%&|<>]')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
    len(lines) AS n_lines, length(regexp_replace(body, '[^\\p{{L}}]+', '', 'g')) AS n_letters, length(regexp_replace(body, '[^\\p{{Lu}}]+', '', 'g')) AS n_capitals
  FROM split LEFT JOIN covered USING (doc_id)
), cast_votes AS (
  SELECT *, [{", ".join(f"CASE WHEN {yes} THEN 1 WHEN {no} THEN -1 ELSE 0 END" for yes, no in rules.values())}] AS votes FROM measures
), patterns AS (SELECT votes, CAST(count(*) AS DOUBLE) AS n FROM cast_votes GROUP BY votes), fit AS (
  SELECT 0 AS round, CAST({START_PRIOR} AS DOUBLE) AS prior, {[START_GOOD] * len(rules)}::DOUBLE[] AS good, {[START_BAD] * len(rules)}::DOUBLE[] AS bad, CAST(1 AS DOUBLE) AS moved
  UNION ALL
  SELECT round, prior, good, bad, greatest({moved}) FROM (
    SELECT round + 1 AS round, was, old_good, old_bad, prior, good, [{", ".join(f"greatest(wrong[{j}], 1 - good[{j}])" for j in many)}] AS bad FROM (
      SELECT round, prior AS was, good AS old_good, bad AS old_bad, {bounded("sum(mass) / sum(n)")} AS prior, [{", ".join(share(1, "mass", j, START_GOOD) for j in many)}] AS good, [{", ".join(share(-1, "(n - mass)", j, START_BAD) for j in many)}] AS wrong
      FROM (SELECT fit.*, votes, n, n * prior * {good} / (prior * {good} + (1 - prior) * {bad}) AS mass FROM fit, patterns WHERE round < {rounds} AND moved >= {SETTLED})
      GROUP BY round, prior, good, bad
    )
  )
), fitted AS (SELECT * FROM fit ORDER BY round DESC LIMIT 1)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {BASE_FAILED} AS base_failed,
  NOT ({BASE_FAILED}) AND prior * {good} / (prior * {good} + (1 - prior) * {bad}) >= {threshold} AS kept
FROM cast_votes, fitted
"""
