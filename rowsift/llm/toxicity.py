"""Toxicity by weak supervision.

1. Voters. Many lexicon and pattern voters look at a text; each votes toxic or abstains:
   public insult words, words and word beginnings of any of ``STEMS`` letters mined from a bounded
   labelled sample (lower confidence bound of their log-odds times their number; of nested beginnings the one
   that gives most evidence), and "several hits" patterns. The number of voters is a parameter.
2. Label model. A generative model of the votes: latent class, each voter's
   firing rate in either class (its accuracy), and the correlation of every
   pair of voters within a class. A voter's evidence is discounted by its
   correlation with the others in both classes, so nested or copied voters do not
   count twice.
   Rates and correlations come from expectation maximisation over the vote
   patterns of all training rows (labelled rows have a fixed class), as
   distributed sums of bounded size (voters x voters).
3. Classifier. A linear model over hashed words and word beginnings, trained with
   follow-the-regularised-leader updates on the label model's posteriors of at most ``max_train``
   labelled rows and as many others: of all training rows, half that the votes call toxic and
   half that they call clean (smallest seeded hashes); scored as sparse dot products over every row.

Only the rows passed as ``labels`` are learnt from. Votes and statistics cover
all training rows; the bound holds for mining and fitting only.

Defined cases: null and empty texts get the logistic of the bias; null ids are scored but not
learnt from; null labels are not used; an id labelled twice counts with its smallest
label, an id with several texts trains with its smallest text; without labels every
score is the prior 0.05; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import fold, give_back, hash_words, keep_rows, mix, per_text, quoted, segment_sum, slices, small_batches, stored, table, words_of
from .linear import DIM, Families, ftrl, logistic, margins, sparse_rows
from .quality_classifier import bounded_labels

MAX_TRAIN = 10_000
REPLICAS = 3
EPOCHS = 5
EM_STEPS = 6
THRESHOLD = 0.5
PRIOR = 0.05
PREFIXES = (4, 5, 6)              # word beginnings that the classifier sees
STEMS = (3, 4, 5, 6, 7, 8)        # word beginnings that may become voters
MINED_WORDS, MINED_PREFIXES = 100, 60
SURE_TOXIC, SURE_CLEAN = 0.9, 0.02
LANE = 62  # voters per long

# Public insult words, one voter each, and lists per language.
SEED_WORDS = ("idiot", "moron", "stupid", "loser", "scum", "trash", "pathetic", "worthless",
              "disgusting", "clown", "jerk", "dumb", "fool", "ugly", "filthy", "coward")
SEED_LISTS = (
    ("imbécile", "stupide", "connard", "minable", "ordure", "crétin"),
    ("dumm", "blöd", "versager", "abschaum", "trottel", "widerlich"),
    ("idiota", "estúpido", "payaso", "basura", "imbécil", "inútil"),
)
OUTER = r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$"


def cores_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct lower-case words without outer punctuation, codes and offsets."""
    flat, starts = words_of(texts)
    d = flat.dictionary_encode()
    e = pc.utf8_lower(pc.replace_substring_regex(d.dictionary, OUTER, "")).dictionary_encode()
    codes = np.asarray(e.indices, dtype=np.int64)[np.asarray(d.indices, dtype=np.int64)]
    return e.dictionary, codes, starts


class Voters:
    """Word lists and word beginnings; the votes of a text are bits of some longs."""

    def __init__(self, words: Sequence[str], prefixes: Sequence[str]):
        """Mined words and beginnings, those that give most evidence first."""
        mined = [w for w in words if w not in SEED_WORDS][:MINED_WORDS]
        self.lists = [(w,) for w in SEED_WORDS] + [*SEED_LISTS] + [(w,) for w in mined]
        self.prefixes: list[str] = []
        for p in prefixes:
            nested = any(p.startswith(q) or q.startswith(p) for q in self.prefixes)
            if len(self.prefixes) < MINED_PREFIXES and not nested and not any(w.startswith(p) for w in SEED_WORDS):
                self.prefixes.append(p)
        self.count = len(self.lists) + len(self.prefixes) + 4

    def shaped(self, words: pa.Array, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Occurrences of words with a mined beginning, and which (beginnings x occurrences)."""
        begins = np.zeros((len(self.prefixes), len(words)), bool)
        for i, p in enumerate(self.prefixes):
            begins[i] = np.asarray(pc.starts_with(words, p))
        at = np.flatnonzero(begins.any(axis=0)[codes])
        return at, begins[:, codes[at]]

    def votes(self, texts: pa.Array) -> np.ndarray:
        """Boolean matrix: texts x voters."""
        return self.votes_of(*cores_of(texts))

    def votes_of(self, words: pa.Array, codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        n, texts_of = len(starts) - 1, per_text(starts)
        out = np.zeros((n, self.count), bool)
        of = {w: i for i, ws in enumerate(self.lists) for w in ws}
        table = list(of)
        found = np.asarray(pc.fill_null(pc.index_in(words, value_set=pa.array(table, words.type)), -1))
        voter = np.append(np.array([of[w] for w in table]), -1)[found]
        hit = voter[codes]
        at = np.flatnonzero(hit >= 0)
        out[texts_of[at], hit[at]] = True
        base = len(self.lists)
        occurrences, begins = self.shaped(words, codes)
        which, place = np.nonzero(begins)
        out[texts_of[occurrences[place]], base + which] = True
        lexical = segment_sum((hit >= 0).astype(np.int64), starts)
        shaped = np.bincount(texts_of[occurrences], minlength=n)
        kinds, length = out[:, :base].sum(axis=1), np.diff(starts)
        out[:, -4:] = np.stack([kinds >= 2, (kinds >= 2) & (100 * lexical >= length),
                                (shaped >= 2) & (100 * shaped >= length), shaped >= 4], axis=1)
        return out


def lanes(votes: np.ndarray) -> np.ndarray:
    """Votes as rows of longs."""
    n = -(-votes.shape[1] // LANE)
    wide = np.zeros((len(votes), n * LANE), np.int64)
    wide[:, :votes.shape[1]] = votes
    return wide.reshape(len(votes), n, LANE) @ (np.int64(1) << np.arange(LANE, dtype=np.int64))


def unlanes(longs: np.ndarray, count: int) -> np.ndarray:
    wide = longs[:, :, None] >> np.arange(LANE, dtype=np.int64) & 1
    return wide.reshape(len(longs), -1)[:, :count]


def lane_column(longs: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.arange(len(longs) + 1, dtype=np.int32) * longs.shape[1]), pa.array(longs.ravel()))


def votes_in(column: pa.Array, count: int) -> np.ndarray:
    n = -(-count // LANE)
    return unlanes(np.asarray(column.flatten()).reshape(-1, n), count).astype(float)


def sample_texts(docs: DataFrame, labels: DataFrame, text_col: str, id_col: str, label_col: str,
                 max_train: int) -> DataFrame:
    """(id, text, label) of at most ``max_train`` labelled rows."""
    chosen = bounded_labels(labels, id_col, label_col, max_train)
    return (docs.select(quoted(id_col).alias("id"), F.coalesce(quoted(text_col), F.lit("")).alias("text"))
            .join(F.broadcast(chosen), "id").groupBy("id")
            .agg(F.min("text").alias("text"), F.min("label").alias("label")))


def mine(sample: DataFrame) -> Voters:
    """Words and word beginnings whose log-odds of toxic are surely high."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches):
            toxic = np.asarray(rows.column(1)) >= 0.5
            words, codes, starts = cores_of(texts)
            text = per_text(starts)
            for size in (0, *STEMS):
                terms = words if size == 0 else pc.utf8_slice_codeunits(words, 0, size)
                long_enough = np.asarray(pc.utf8_length(words)) >= max(size + 1, 3)
                d = terms.dictionary_encode()
                term = np.asarray(d.indices, dtype=np.int64)[codes]
                use = long_enough[codes]
                pair = np.unique(text[use] * (len(d.dictionary) + 1) + term[use])
                t, term = pair // (len(d.dictionary) + 1), pair % (len(d.dictionary) + 1)
                pos = np.bincount(term[toxic[t]], minlength=len(d.dictionary))
                neg = np.bincount(term[~toxic[t]], minlength=len(d.dictionary))
                some = np.flatnonzero(pos)
                other = np.flatnonzero((pos == 0) & (neg > 0))
                keep = np.concatenate((some, other))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(keep), size), pa.int32()), d.dictionary.take(pa.array(keep)).cast(pa.string()),
                     pa.array(pos[keep]), pa.array(neg[keep])], names=["size", "term", "pos", "neg"])

    totals = sample.agg(F.coalesce(F.sum(F.when(F.col("label") >= 0.5, 1).otherwise(0)), F.lit(0)).alias("p"),
                        F.count("*").alias("n")).first()
    if not totals.p or totals.p == totals.n:
        return Voters((), ())
    p, q = float(totals.p), float(totals.n - totals.p)
    pos, neg = F.col("pos"), F.col("neg")
    odds = F.log((pos + 0.5) / (p - pos + 0.5)) - F.log((neg + 0.5) / (q - neg + 0.5))
    sure = odds - 2.0 * F.sqrt(1 / (pos + 0.5) + 1 / (neg + 0.5))
    terms = (sample.select("text", "label").mapInArrow(count, "size int, term string, pos long, neg long")
             .groupBy("size", "term").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
             .filter("pos >= 3").withColumn("sure", sure).filter("sure > 1")
             .withColumn("worth", F.col("pos") * F.col("sure")))      # how much evidence it gives in all
    terms = stored(terms, "mined-terms")                              # counted once for words and beginnings
    words = terms.filter("size = 0").orderBy(F.desc("worth"), "term").limit(MINED_WORDS + len(SEED_WORDS))
    heads = terms.filter("size > 0").orderBy(F.desc("worth"), "term").limit(20 * MINED_PREFIXES)
    rows = words.unionByName(heads).orderBy(F.desc("worth"), "term").collect()
    return Voters([r.term for r in rows if r["size"] == 0], [r.term for r in rows if r["size"]])


class LabelModel:
    """Firing rates per class, class prior and evidence discounts."""

    def __init__(self, count: int):
        self.prior = PRIOR
        self.rates = np.array([np.full(count, 0.002), np.full(count, 0.2)])
        self.discount = np.ones(count)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        r0, r1 = self.rates
        yes = self.discount * (np.log(r1) - np.log(r0))
        no = self.discount * (np.log1p(-r1) - np.log1p(-r0))
        return logistic(np.log(self.prior / (1 - self.prior)) + no.sum() + votes @ (yes - no))

    def update(self, pairs: np.ndarray, mass: np.ndarray) -> None:
        """``pairs[y]``: expected co-firings in class y (diagonal: firings)."""
        self.prior = float(np.clip((mass[1] + 1) / (mass.sum() + 2), 1e-4, 0.5))
        fired = np.array([np.diag(p) for p in pairs])
        self.rates = np.clip((fired + 0.1) / (mass[:, None] + 1), 1e-5, 1 - 1e-5)
        linked = np.ones_like(pairs[0])
        for y in (0, 1):
            total = max(mass[y], 1)
            p = fired[y] / total
            spread = np.sqrt(p * (1 - p) + 3 / total)  # a few joint firings prove nothing
            together = (pairs[y] / total - np.outer(p, p)) / np.outer(spread, spread)
            always = p > 0.95  # nothing varies there, so nothing speaks against a link
            linked = np.minimum(linked, np.where(always[:, None] | always, 1, together))
        total = max(mass.sum(), 1)
        p = fired.sum(axis=0) / total
        spread = np.sqrt(p * (1 - p) + 3 / total)
        overall = (pairs.sum(axis=0) / total - np.outer(p, p)) / np.outer(spread, spread)
        linked = np.where(overall > 0.8, overall, linked)  # as good as copies, whatever the classes
        np.fill_diagonal(linked, 0)
        self.discount = 1 / (1 + np.where(linked > 0.2, linked, 0).sum(axis=1))


def fit_label_model(patterns: DataFrame, count: int, steps: int = EM_STEPS) -> LabelModel:
    """EM over (known class or -1, vote lanes, number of rows). Rows of known class, if there are some of both, give the
    first rates: from set ones the silence of many voters outweighs the few that fire in any toxic text."""
    model = LabelModel(count)

    def expect(current: LabelModel, first: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            pairs, mass = np.zeros((2, count, count)), np.zeros(2)
            for b in batches:
                v = votes_in(b.column("v"), count)
                n, known = np.asarray(b.column("n"), dtype=float), np.asarray(b.column("known"))
                q = np.where(known < 0, current.posterior(v), known)
                if first:
                    n = np.where(known < 0, 0, n)
                for y, w in ((0, n * (1 - q)), (1, n * q)):
                    pairs[y] += (v * w[:, None]).T @ v
                    mass[y] += w.sum()
            i, j = np.triu_indices(count)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.append(i, -1)), pa.array(np.append(j, -1)),
                 pa.array(np.append(pairs[0][i, j], mass[0])), pa.array(np.append(pairs[1][i, j], mass[1]))],
                names=["i", "j", "c0", "c1"])
        return run

    for step in range(-1, steps):
        sums = (patterns.mapInArrow(expect(model, step < 0), "i long, j long, c0 double, c1 double")
                .groupBy("i", "j").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1")).collect())
        pairs, mass = np.zeros((2, count, count)), np.zeros(2)
        for r in sums:
            if r.i < 0:
                mass[:] = r.c0, r.c1
            else:
                pairs[:, r.i, r.j] = pairs[:, r.j, r.i] = r.c0, r.c1
        if step >= 0 or mass.all():
            model.update(pairs, mass)
    return model


def unlabelled(voted: DataFrame, model: LabelModel, max_train: int) -> DataFrame:
    """Ids of at most ``max_train`` rows without a label: of those that the votes call toxic and
    of those that they call clean the ones with the smallest seeded hashes."""
    def sure(v: pa.Array) -> pa.Array:
        q = model.posterior(votes_in(v, len(model.discount)))
        return pa.array(np.where(q >= SURE_TOXIC, 1, np.where(q <= SURE_CLEAN, 0, -1)).astype(np.int32))

    said = voted.filter("known < 0 and id is not null").select("id", F.arrow_udf(sure, "int")("v").alias("said"))
    each = [said.filter(F.col("said") == k).select("id").distinct().orderBy(F.xxhash64("id", F.lit(19)), "id").limit(max_train // 2)
            for k in (1, 0)]
    return each[0].unionByName(each[1])


def features(texts: pa.Array, voters: Voters) -> Families:
    """Hashed words, word beginnings, how often and how densely a mined beginning
    occurs, and the fired voters."""
    words, codes, starts = cores_of(texts)
    out: Families = []
    for size in (0, *PREFIXES):
        terms = words if size == 0 else pc.utf8_slice_codeunits(words, 0, size)
        d = terms.dictionary_encode()
        h = hash_words(d.dictionary.to_pylist(), 20 + size)[np.asarray(d.indices, dtype=np.int64)]
        out.append((h[codes] if len(codes) else np.zeros(0, np.uint64), starts))
    text, length = per_text(starts), np.maximum(np.diff(starts), 1)
    at, made = [], []
    occurrences, begins = voters.shaped(words, codes)
    for i, mine in enumerate(begins):
        n = np.bincount(text[occurrences[mine]], minlength=len(length))
        some = np.flatnonzero(n)
        often, dense = np.minimum(n[some], 5), np.minimum(400 * n[some] // length[some], 8)
        for kind, value in ((0, often), (1, dense)):
            at.append(some)
            made.append(mix((np.uint64(i * 64 + kind * 32) + value.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)))
    row, voter = np.nonzero(voters.votes_of(words, codes, starts))
    at.append(row)
    made.append(mix((voter.astype(np.uint64) + np.uint64(1 << 20)) * np.uint64(0x9E3779B97F4A7C15)))
    at, made = np.concatenate(at), np.concatenate(made)
    order = np.argsort(at, kind="stable")
    offsets = np.concatenate(([0], np.cumsum(np.bincount(at, minlength=len(length)))))
    out.append((made[order], offsets))
    return out


def train(docs: DataFrame, labels: DataFrame, learn_from: Column, text_col: str = "text",
          id_col: str = "doc_id", label_col: str = "toxic", max_train: int = MAX_TRAIN,
          replicas: int = REPLICAS, epochs: int = EPOCHS) -> tuple[np.ndarray, float, Voters]:
    """Weights, bias and the voters. ``learn_from``: which rows of ``docs`` and ``labels`` may be used."""
    small_batches(docs.sparkSession)
    labels = labels.filter(learn_from)
    sample = sample_texts(docs, labels, text_col, id_col, label_col, max_train)
    voters = mine(sample)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, texts in slices(batches):
            yield pa.RecordBatch.from_arrays([rows.column(1), lane_column(lanes(voters.votes(texts)))], names=["id", "v"])

    rows = docs.filter(learn_from).select(quoted(text_col).alias("text"), quoted(id_col).alias("id"))
    kind = rows.schema["id"].dataType.simpleString()
    known = (labels.select(quoted(id_col).alias("id"), quoted(label_col).cast("double").alias("known"))
             .filter("id is not null and known is not null").groupBy("id").agg(F.min("known").alias("known")))
    voted = stored(rows.mapInArrow(vote, f"id {kind}, v array<long>").join(known, "id", "left")
                   .withColumn("known", F.coalesce("known", F.lit(-1.0))), "votes")
    patterns = stored(voted.groupBy("known", "v").agg(F.count("*").alias("n")), "vote-patterns")
    model = fit_label_model(patterns, voters.count)
    others = unlabelled(voted, model, max_train)
    sample = sample.select("id", "text").unionByName(
        rows.join(F.broadcast(others), "id").groupBy("id").agg(F.min("text").alias("text"))
        .select("id", F.coalesce("text", F.lit("")).alias("text")))

    def fit(group: pa.Table) -> pa.Table:
        group = group.sort_by("id")
        out, soft = [], []
        for _, texts in slices(iter(group.select(["text"]).to_batches())):
            out += sparse_rows(features(texts, voters), presence=True)
            soft.append(model.posterior(voters.votes(texts).astype(float)))
        w, b = ftrl(out, np.concatenate(soft), epochs, alpha=0.3, beta=1.0, l1=2.0, l2=1e-3)
        at = np.flatnonzero(w)
        out.clear()
        give_back()
        return pa.table({"slot": pa.array(np.append(at, DIM), pa.int64()),
                         "w": pa.array(np.append(w[at], b), pa.float64())})

    groups = sample.withColumn("replica", F.pmod(F.xxhash64("id", F.lit(5)), F.lit(replicas)).cast("int"))
    models = groups.groupBy("replica").applyInArrow(fit, "slot long, w double").groupBy("slot").agg(
        F.sum("w").alias("w"), F.count("*").alias("n")).collect()
    weights = np.zeros(DIM + 1)
    weights[DIM] = np.log(PRIOR / (1 - PRIOR))  # stands if there is nothing to learn from
    made = next((r.n for r in models if r.slot == DIM), 1)
    for r in models:
        weights[r.slot] = r.w / made
    return weights[:DIM].astype(np.float32), float(weights[DIM]), voters


def score(docs: DataFrame, weights: np.ndarray, bias: float, voters: Voters, text_col: str = "text",
          id_col: str = "doc_id") -> DataFrame:
    """(id, score) of every row: one scan, no shuffle."""
    small_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast((weights, bias, voters))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, b, voters = model.value
        for rows, texts in slices(batches):
            s = logistic(margins(features(texts, voters), w, b, presence=True))
            yield pa.RecordBatch.from_arrays([rows.column(1), pa.array(s)], names=["id", "score"])

    kept = docs.select(quoted(text_col).alias("text"), quoted(id_col).alias("id"))
    kind = kept.schema["id"].dataType.simpleString()
    return kept.mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_col)


def keep_clean(docs: DataFrame, weights: np.ndarray, bias: float, voters: Voters,
               threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``; all columns stay."""
    model = docs.sparkSession.sparkContext.broadcast((weights, bias, voters))

    def decide(texts: pa.Array) -> np.ndarray:
        w, b, voters = model.value
        return logistic(margins(features(texts, voters), w, b, presence=True)) < threshold

    return keep_rows(docs, text_col, decide)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, *train(docs, table(spark, sf_dir, "labels"), fold("doc_id") != 0))
    return scored.select("doc_id", (fold("doc_id") == 0).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES = {"op4_toxicity": op4_toxicity}
