"""Mixing documents to target domain weights with soft domain membership."""

from __future__ import annotations

import math
import warnings
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, free_name, let, saved

BUCKETS = 1 << 15
STEM = 5
#: Log ratios nearer to 0 are left out: they tell long documents from short ones, not domains apart.
LEAST_RATIO = math.log(4)
#: Bounds between levels of evidence.
LEVELS = (2.0, 4.0, 8.0)


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+", -1), lambda w: w != "")


def signs(text: Column, tokens: Column) -> Column:
    """The distinct hashes (32 bits) of the stems (first letters) of a text's words, and three of its traits in bins: repeated words, marks and capitals a word."""
    n = F.greatest(F.size(tokens), F.lit(1))
    traits = [
        ("#distinct", 10 * F.size(F.array_distinct(tokens)) / n),
        ("#marks", 10 * F.regexp_count(text, F.lit(r"[^\p{L}\p{N}\s.,;:?'\"()-]")) / n),
        ("#capitals", 10 * F.regexp_count(text, F.lit(r"\p{Lu}{2}")) / n),
    ]
    binned = [F.crc32(F.concat(F.lit(name), F.least(F.lit(20), F.floor(F.coalesce(x, F.lit(0.0)))).cast("string"))) for name, x in traits]
    return F.array_distinct(F.concat(F.transform(tokens, lambda w: F.crc32(F.substring(w, 1, STEM))), F.array(*binned)))


def _constant(values: list, kind: str) -> Column:
    """The numbers as one constant array."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast(f"array<{kind}>")


@dataclass
class Domains:
    """A domain classifier: which sign each bucket stands for, its weight for each domain, and the domains' shares at each level of evidence."""

    names: list[str]
    signs: list[int]
    weights: list[list[float]]
    shares: list[list[float]]

    def evidence(self, found: Column) -> Column:
        """Sums of the weights of the signs ``found``, one a domain. A sign that only shares a bucket with a known one counts nothing, so long texts gather no chance hits."""
        held = _constant(self.signs, "bigint")
        bucket = lambda h: (h % BUCKETS).cast("int")
        tables = [_constant([f"{x:.4f}" if x else 0 for x in w], "double") for w in self.weights]
        total = lambda known, t: F.aggregate(known, F.lit(0.0), lambda acc, h: acc + F.get(t, bucket(h)))
        return let(F.filter(found, lambda h: F.get(held, bucket(h)) == h), lambda known: F.array(*[total(known, t) for t in tables]))

    def level(self, found: Column) -> Column:
        """0 without evidence, else a number for the domain of most evidence and how far it is ahead of the next."""

        def of(e: Column) -> Column:
            order = F.sort_array(e, asc=False)
            ahead = F.get(order, 0) - F.greatest(F.coalesce(F.get(order, 1), F.lit(0.0)), F.lit(0.0))
            step = sum((F.when(ahead > x, 1).otherwise(0) for x in LEVELS), F.lit(0))
            place = (F.array_position(e, F.array_max(e)) - 1).cast("int")
            return F.when(ahead <= 0, 0).otherwise(1 + place * (len(LEVELS) + 1) + step)

        return let(self.evidence(found), of)

    def posterior(self, found: Column) -> Column:
        table = F.array(*[F.array(*[F.lit(float(x)) for x in row]) for row in self.shares])
        return F.get(table, self.level(found))


def fit_domains(labelled: DataFrame, domains: list[str], certain: float = 4.5) -> Domains:
    """The classifier from a bounded table (``__text``, ``domain``).

    Copies count once, so a large group of them makes no sign sure. Weights are learnt on one half of the texts (by a hash of the text): a sign's weight for a domain is the log ratio of its rate inside to its rate outside, and 0 unless the
    likelihood ratio is ``certain`` standard errors, and the ratio ``LEAST_RATIO``, from 0; so few of the many rare signs count by chance, whatever the number of labels. The other half calibrates: a text's posterior is
    the domains' shares among that half's texts of its level of evidence, with one document of prior. A domain without labelled rows gets no evidence and a prior of half a document.
    Counting and testing signs is one distributed aggregate; at most ``BUCKETS`` signs, the surest of each bucket, reach the driver.
    """
    half = F.pmod(F.xxhash64("__text", F.lit("half")), F.lit(2))
    rows = saved(labelled.filter(F.col("domain").isin(domains)).select("domain", half.alias("half"), let(words(F.col("__text")), lambda w: signs(F.col("__text"), w)).alias("found")).distinct(), "labelled")
    sizes = {(r.domain, r.half): r.n for r in rows.groupBy("domain", "half").agg(F.count("*").alias("n")).collect()}
    learnt = [sizes.get((d, 0), 0) for d in domains]
    whole = [sizes.get((d, 0), 0) + sizes.get((d, 1), 0) for d in domains]

    counts = rows.filter("half = 0").select("domain", F.explode("found").alias("h")).groupBy("h").agg(F.count("*").cast("double").alias("all"), *[F.count_if(F.col("domain") == d).cast("double").alias(f"n{i}") for i, d in enumerate(domains)])

    def tested(i: int) -> Column:
        """Struct (weight, squared standard errors) of a sign for a domain."""
        inside, outside = float(learnt[i]), float(sum(learnt) - learnt[i])
        if not inside or not outside:
            return F.struct(F.lit(0.0).alias("w"), F.lit(0.0).alias("g"))
        a, b = F.col(f"n{i}"), F.col("all") - F.col(f"n{i}")
        share = F.col("all") / (inside + outside)
        cells = [(a, inside * share), (b, outside * share), (inside - a, inside * (1 - share)), (outside - b, outside * (1 - share))]
        g = 2 * sum((F.when((o > 0) & (e > 0), o * F.ln(o / e)).otherwise(0.0) for o, e in cells), F.lit(0.0))
        ratio = F.ln((a + 0.5) / (inside + 1)) - F.ln((b + 0.5) / (outside + 1))
        return F.struct(F.when((g >= certain**2) & (F.abs(ratio) > LEAST_RATIO), ratio).otherwise(0.0).alias("w"), g.alias("g"))

    judged = counts.select("h", F.array(*[tested(i) for i in range(len(domains))]).alias("t")).filter(F.exists("t", lambda x: x["w"] != 0))
    surest = judged.groupBy((F.col("h") % BUCKETS).alias("b")).agg(F.max(F.struct(F.array_max(F.transform("t", lambda x: x["g"])).alias("g"), "h", F.transform("t", lambda x: x["w"]).alias("w"))).alias("m"))
    model = Domains(list(domains), [-1] * BUCKETS, [[0.0] * BUCKETS for _ in domains], [])
    for r in surest.select("b", "m.h", "m.w").collect():
        model.signs[r.b] = r.h
        for table, w in zip(model.weights, r.w, strict=True):
            table[r.b] = w

    prior = [(n + 0.5) / (sum(whole) + 0.5 * len(domains)) for n in whole]
    seen = {(r.level, r.domain): r.n for r in rows.filter("half = 1").groupBy(model.level(F.col("found")).alias("level"), "domain").agg(F.count("*").alias("n")).collect()}
    for level in range(1 + len(domains) * (len(LEVELS) + 1)):
        found = [seen.get((level, d), 0) for d in domains]
        model.shares.append([(n + p) / (sum(found) + 1) for n, p in zip(found, prior, strict=True)])
    return model


def membership(text: Column, model: Domains) -> Column:
    """Struct (``n_tokens``, ``p`` array in the order of the model's names): words of the whole text and domain posteriors."""
    return let(words(text), lambda w: F.struct(F.size(w).cast("long").alias("n_tokens"), model.posterior(signs(text, w)).alias("p")))


def rate_of(p: Column, steps: list[list[float]], most: float | None = None) -> Column:
    """The document rate after the projected steps, from 1: each takes the membership-weighted step off and stops at 0 and at ``most``."""
    rate = F.lit(1.0)
    if not steps:
        return rate
    table = F.array(*[F.array(*[F.lit(float(x)) for x in s]) for s in steps])

    def bounded(r: Column) -> Column:
        return F.greatest(F.lit(0.0), r if most is None else F.least(F.lit(float(most)), r))

    return F.aggregate(table, rate, lambda r, s: bounded(r - F.aggregate(F.zip_with(p, s, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)))


def _solve(matrix: list[list[float]], right: list[float]) -> list[float]:
    """Solution of a small symmetric system by elimination, with a slight ridge."""
    k = len(right)
    ridge = 1e-9 * max(1e-300, max(matrix[i][i] for i in range(k)))
    rows = [[matrix[i][j] + (ridge if i == j else 0.0) for j in range(k)] + [right[i]] for i in range(k)]
    for i in range(k):
        pivot = max(range(i, k), key=lambda r: abs(rows[r][i]))
        rows[i], rows[pivot] = rows[pivot], rows[i]
        for r in range(k):
            if r != i and rows[i][i]:
                f = rows[r][i] / rows[i][i]
                rows[r] = [a - f * b for a, b in zip(rows[r], rows[i], strict=True)]
    return [rows[i][k] / rows[i][i] if rows[i][i] else 0.0 for i in range(k)]


def fit_rates(members: DataFrame, targets: list[float], rounds: int = 40, tolerance: float = 1e-5, most: float | None = None) -> list[list[float]]:
    """Steps of projected-gradient least squares on (``n_tokens``, ``p``) so that expected domain token totals meet ``targets``; rates lie between 0 and ``most`` (no bound if None).

    A step is r <- clip(r - p . s). First s is tried that solves G s = totals - targets for G = sum of n p p' over the documents whose rate is not 0; where that
    does not bring the totals nearer, s is the gap over the trace of G of all documents, the gradient step that always does unless the rates are the best there are. A round is one
    aggregate of as many sums as there are pairs of domains; a rate is a fold over the steps so far, so nothing is kept per document between rounds. Ends when all gaps are within
    ``tolerance`` of all tokens or no longer fall; gaps that are left (targets that no such rates meet) are warned of.
    """
    k = len(targets)

    def totals(steps: list[list[float]]) -> tuple[list[float], list[list[float]]]:
        rated = members.select("n_tokens", "p", rate_of(F.col("p"), steps, most).alias("r"))
        live = F.when(F.col("r") > 0, F.col("n_tokens")).otherwise(0)
        row = rated.agg(
            *[F.sum(F.col("r") * F.col("n_tokens") * F.get("p", i)).alias(f"t{i}") for i in range(k)],
            *[F.sum(live * F.get("p", i) * F.get("p", j)).alias(f"g{i}_{j}") for i in range(k) for j in range(k)],
        ).first()
        return [row[f"t{i}"] or 0.0 for i in range(k)], [[row[f"g{i}_{j}"] or 0.0 for j in range(k)] for i in range(k)]

    have, gram = totals([])
    size, trace = max(sum(have), 1.0), max(sum(gram[i][i] for i in range(k)), 1.0)
    steps: list[list[float]] = []
    gaps = [h - t for h, t in zip(have, targets, strict=True)]
    solved = True
    for _ in range(rounds):
        if max(map(abs, gaps), default=0.0) <= tolerance * size:
            break
        step = _solve(gram, gaps) if solved else [x / trace for x in gaps]
        have, fresh = totals([*steps, step])
        after = [h - t for h, t in zip(have, targets, strict=True)]
        gain = 1 - sum(x * x for x in after) / sum(x * x for x in gaps)
        if gain > 0:
            steps, gaps, gram = [*steps, step], after, fresh
        if gain <= 1e-3 and not solved:
            break
        solved = gain > 1e-3
    if max(map(abs, gaps), default=0.0) > tolerance * size:
        warnings.warn(f"expected tokens miss their targets by {[round(g) for g in gaps]} of {round(size)}", stacklevel=2)
    return steps


def label_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of a label table: toxic, else junk or clean by quality. Rows without id or quality are left out; an id with several labels takes the worst."""
    rank = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    worst = labels.select("doc_id", rank.alias("r")).filter("doc_id is not null and r is not null").groupBy("doc_id").agg(F.min("r").alias("r"))
    return worst.select("doc_id", F.element_at(F.array(F.lit("toxic"), F.lit("junk"), F.lit("clean")), F.col("r") + 1).alias("domain"))


def fit_model(docs: DataFrame, labelled: DataFrame, domains: list[str], train_rows: int = 20000, id_col: str = "doc_id", text_col: str = "text") -> Domains:
    """The domain classifier from about ``train_rows`` labelled documents (id, ``domain``), chosen by a hash of the id; all, if there are no more."""
    few = bounded_sample(labelled, F.col(id_col), train_rows, labelled.count()).select(F.col(id_col).alias("__id"), "domain")
    texts = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    return fit_domains(texts.join(F.broadcast(few), "__id").select("__text", "domain"), domains)


def rates(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], train_rows: int = 20000, total: float | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, n_tokens, ``p_<domain>``, rate), one for each document.

    ``targets`` are the domains' shares of expected tokens, ``total`` their sum in tokens (default: all the tokens there are). Null, empty and
    wordless texts have no tokens and take the rate of their posterior; repeated rows count each; an empty table gives no rows. Extra columns are not looked at.
    """
    domains = list(targets)
    model = fit_model(docs, labelled, domains, train_rows, id_col, text_col)
    members = saved(docs.select(F.col(id_col).alias("__id"), membership(F.col(text_col), model).alias("m")).select("__id", "m.n_tokens", "m.p"), "members")
    size = total if total is not None else (members.agg(F.sum("n_tokens")).first()[0] or 0)
    whole = sum(targets.values())
    steps = fit_rates(members, [size * w / whole for w in targets.values()])
    return members.select(F.col("__id").alias(id_col), "n_tokens", *[F.get("p", i).alias(f"p_{d}") for i, d in enumerate(domains)], rate_of(F.col("p"), steps).alias("rate"))


def mixed(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], train_rows: int = 20000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` drawn by their rates: each row stays with probability of its rate, at most 1, by a hash of its id and text.

    The targets' total is that at which the domain of the largest share keeps its tokens, so that surplus domains thin out to theirs. All domains are fitted, with rates of at most 1, since no row is repeated,
    and the rates are applied as they are; a domain short of its target so stays, with a warning. Without labelled rows nothing is known of any document and all
    stay. Repeated rows fall or stay together.
    """
    if labelled.isEmpty():
        return docs
    model = fit_model(docs, labelled, list(targets), train_rows, id_col, text_col)
    # Stored before it is used: the fold over the steps would repeat the work on the text.
    name = free_name(docs, "membership")
    scored = saved(docs.withColumn(name, membership(F.col(text_col), model)), "members")
    members = scored.select(f"{name}.n_tokens", f"{name}.p")
    shares = list(targets.values())
    found = members.agg(*[F.sum(F.col("n_tokens") * F.get("p", i)).alias(f"t{i}") for i in range(len(shares))]).first()
    main = max(range(len(shares)), key=lambda i: shares[i])
    steps = fit_rates(members, [s * (found[main] or 0.0) / shares[main] for s in shares], most=1.0)
    draw = F.pmod(F.xxhash64(F.col(id_col), F.col(text_col), F.lit("mix")), F.lit(1 << 30)) / float(1 << 30)
    return scored.filter(draw < rate_of(F.col(name)["p"], steps, 1.0)).drop(name)
