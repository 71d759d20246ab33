"""Quality by perplexity under an interpolated modified Kneser-Ney model of trusted text.

The model is over characters, runs of white space counting as one blank, and has ``ORDER``
characters. It is counted on all trusted documents but a fifth, which is held out. Characters
beyond the first code points share classes, so that a gram fits in one long.

What is counted or looked up are the distinct grams of a chunk of text, packed and sent to
the tasks that own their range. Counts, discounts and the probabilities of the grams that occur
anywhere are computed by DataFrame joins over distinct grams, order by order:
``p(g) = (count - discount) / total + weight * p(g without its first character)``. Each
chunk gets back one number per distinct gram; texts never move.

A text's score is its mean negative log probability per character, drawn towards its
language's median as by ``PRIOR`` more characters, so that short texts are judged with
caution. The threshold of a language is the quantile ``QUANTILE`` of its held-out trusted
texts' scores, so that the share of clean texts lost is what lies above it. Texts too few to
have one above the quantile (under 100 at 0.99) widen it by its distance from their median
times the missing share, at 50 by half. A language's values are drawn to those of all held-out
texts, as if ``FEW`` texts more had those: by half at ``FEW`` texts, hardly at thousands. Unknown
languages have the values of all. ``perplexity`` is e to the score.

As a mean hides a few foreign words in a long text, a text's worst stretch is judged too: the
highest sum over ``STRETCH`` characters in a row, by its own threshold, found alike. A text
is accepted if neither is above its threshold; the results show the first. A few texts widen
the worst stretch's threshold further, by ``FEW`` times one text's share.

Texts that are null or white space have no perplexity and are not kept. Without any trusted
held-out text there is no threshold, and all others are kept. Several labels of a document
count as trusted if all are. Repeated rows are scored each; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spikewatch.llm.batches import offsets_of, pack_rising, unpack_rising
from spikewatch.llm.tables import chunked, keep
from spikewatch.llm.words import mixed

ORDER = 4
BITS = 12
# Code points below it are their own class, the others share the rest.
OWN_CLASS = 3072
CHUNK_BYTES = 2 << 20
QUANTILE = 0.99
# Held-out texts that a language's own values count for half at.
FEW = 20
PRIOR = 40
HELD_OUT = 5
# Characters of a stretch judged by itself.
STRETCH = 8
# Languages with a threshold of their own, the most frequent first; there are fewer in the world.
MOST_LANGUAGES = 10_000

RESULTS = ("perplexity", "threshold", "accepted")

SENT = "shard int, chunk long, count long, grams binary, uses binary"
COUNTED = "shard int, gram long, uses long"
REPLY = "chunk long, shard int, nats binary"
SCORED = "chunk long, place long, nats double, n long, worst double"


def classes(text: str) -> np.ndarray:
    """Character classes of a text with single blanks, between a start and an end."""
    codes = np.frombuffer(" ".join(text.split()).encode("utf-32-le", "replace"), "<u4")
    codes = codes.astype(np.int64)
    shared = OWN_CLASS + codes % ((1 << BITS) - OWN_CLASS)
    return np.r_[np.zeros(ORDER - 1, np.int64), np.where(codes < OWN_CLASS, codes, shared), 32]


def grams_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """All grams of the texts in a row, and how many each has."""
    parts, lengths = [], []
    for text in texts:
        if not text or text.isspace():
            lengths.append(0)
            continue
        own = classes(text)
        n = len(own) - ORDER + 1
        gram = np.zeros(n, np.int64)
        for at in range(ORDER):
            gram = gram << BITS | own[at : at + n]
        parts.append(gram)
        lengths.append(n)
    every = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return every, np.array(lengths, np.int64)


def sharded(grams: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of distinct grams by shard and gram, and their shards in that order."""
    shard = (mixed(grams.astype(np.uint64)) >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)
    order = np.lexsort((grams, shard))
    return order, shard[order].astype(np.int64)


def worst_stretches(sums: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The highest sum over a stretch in each text, of all of it if it is shorter."""
    out = np.zeros(len(ends) - 1)
    for n, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)):
        wide = min(STRETCH, b - a)
        out[n] = (sums[a + wide : b + 1] - sums[a : b + 1 - wide]).max()
    return out


def _table(rows: list[dict], names: str) -> pa.Table:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "double": pa.float64()}
    fields = [field.split(" ") for field in names.split(", ")]
    return pa.Table.from_pylist(rows, pa.schema([(name, kinds[kind]) for name, kind in fields]))


def _sent(chunk: int, grams: np.ndarray, uses: np.ndarray, shards: int) -> pa.Table:
    order, shard = sharded(grams, shards)
    grams, uses = grams[order].astype(np.uint64), uses[order].astype("<u4")
    cuts = np.searchsorted(shard, np.arange(shards + 1))
    rows = []
    for n in np.unique(shard).tolist():
        a, b = int(cuts[n]), int(cuts[n + 1])
        rows.append(
            {
                "shard": n,
                "chunk": chunk,
                "count": b - a,
                "grams": pack_rising(grams[a:b]),
                "uses": uses[a:b].tobytes(),
            }
        )
    return _table(rows, SENT)


def _received(rows: pa.Table) -> list[np.ndarray]:
    pairs = zip(rows["grams"].to_pylist(), rows["count"].to_pylist(), strict=True)
    return [unpack_rising(grams, n).view(np.int64) for grams, n in pairs]


def _counted(key: tuple, rows: pa.Table) -> pa.Table:
    """The distinct grams of a shard with their uses in all."""
    grams = np.concatenate(_received(rows))
    uses = np.concatenate([np.frombuffer(u, "<u4") for u in rows["uses"].to_pylist()])
    distinct, at = np.unique(grams, return_inverse=True)
    total = np.bincount(at, weights=uses).astype(np.int64)
    shard = np.full(len(distinct), key[0].as_py(), np.int32)
    return pa.table({"shard": shard, "gram": distinct, "uses": total})


def prefix(gram: Column) -> Column:
    return F.shiftright(gram, BITS)


def suffix(gram: Column, length: int) -> Column:
    return gram.bitwiseAND(F.lit((1 << BITS * (length - 1)) - 1))


def discounts(counts: DataFrame) -> list[float]:
    """What is taken off a count of 1, 2 and 3 or more."""
    few = counts.filter("uses <= 4").groupBy("uses").count().collect()
    ones, twos, threes, fours = (max({r[0]: r[1] for r in few}.get(n, 0), 1) for n in (1, 2, 3, 4))
    y = ones / (ones + 2 * twos)
    raw = (1 - 2 * y * twos / ones, 2 - 3 * y * threes / twos, 3 - 4 * y * fours / threes)
    return [min(max(value, 0.1), n) for n, value in enumerate(raw, 1)]


def probabilities(counts: DataFrame, asked: DataFrame) -> DataFrame:
    """``gram, nats`` (negative log probability) of the asked distinct grams.

    ``counts`` are the grams of the highest order with their uses; lower orders count in how
    many distinct contexts a gram appears.
    """
    by_order = {ORDER: counts.select("gram", "uses")}
    needed = {ORDER: asked.select("gram")}
    for n in range(ORDER, 1, -1):
        shorter = suffix(F.col("gram"), n).alias("gram")
        fewer = by_order[n].groupBy(shorter).agg(F.count("*").alias("uses"))
        by_order[n - 1] = keep(fewer, f"counts-{n - 1}")
        needed[n - 1] = keep(needed[n].select(shorter).distinct(), f"asked-{n - 1}")
    even = 1 / (by_order[1].count() + 1)
    below = None
    for n in range(1, ORDER + 1):
        off = discounts(by_order[n])
        uses = F.col("uses")
        taken = F.when(uses == 1, off[0]).when(uses == 2, off[1]).otherwise(off[2])
        rows = by_order[n].select("gram", "uses", prefix(F.col("gram")).alias("context"))
        contexts = rows.groupBy("context").agg(
            F.sum("uses").alias("total"), F.sum(taken).alias("taken")
        )
        own = rows.join(contexts, "context").select(
            "gram", ((uses - taken) / F.col("total")).alias("own")
        )
        weights = contexts.select("context", (F.col("taken") / F.col("total")).alias("weight"))
        found = (
            needed[n]
            .withColumn("context", prefix(F.col("gram")))
            .join(own, "gram", "left")
            .join(weights, "context", "left")
            .withColumn("shorter", suffix(F.col("gram"), n))
        )
        if below is None:
            found = found.withColumn("lower", F.lit(even))
        else:
            found = found.join(below, "shorter")
        chance = F.coalesce("own", F.lit(0.0)) + F.coalesce("weight", F.lit(1.0)) * F.col("lower")
        below = found.select(F.col("gram").alias("shorter"), chance.alias("lower"))
        if n < ORDER:
            below = keep(below, f"chances-{n}")
    return below.select(F.col("shorter").alias("gram"), (-F.log("lower")).alias("nats"))


def _scores(table: DataFrame, trusted: DataFrame, shards: int) -> DataFrame:
    """``chunk, place, nats, n, worst`` of every row: the sum of nats, how many characters,
    and the highest sum of a stretch.
    """

    def distinct(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        return np.unique(grams_of(texts)[0], return_counts=True)

    def send(key: tuple, rows: pa.Table) -> pa.Table:
        return _sent(key[0].as_py(), *distinct(rows["text"].to_pylist()), shards)

    def send_trusted(key: tuple, rows: pa.Table, good: pa.Table) -> pa.Table:
        if not rows.num_rows or not good.num_rows:
            return _table([], SENT)
        wanted = set(good["place"].to_pylist())
        pairs = zip(rows["place"].to_pylist(), rows["text"].to_pylist(), strict=True)
        texts = [text for place, text in pairs if place in wanted]
        return _sent(key[0].as_py(), *distinct(texts), shards)

    def answer(key: tuple, rows: pa.Table, known: pa.Table) -> pa.Table:
        grams, nats = known["gram"].to_numpy(), known["nats"].to_numpy().astype("<f4")
        order = np.argsort(grams)
        grams, nats = grams[order], nats[order]
        own = [nats[np.searchsorted(grams, asked)].tobytes() for asked in _received(rows)]
        return pa.table(
            {"chunk": rows["chunk"], "shard": rows["shard"], "nats": pa.array(own, pa.binary())}
        )

    def score(key: tuple, rows: pa.Table, replies: pa.Table) -> pa.Table:
        every, lengths = grams_of(rows["text"].to_pylist())
        grams, at = np.unique(every, return_inverse=True)
        order, _ = sharded(grams, shards)
        pairs = zip(replies["shard"].to_pylist(), replies["nats"].to_pylist(), strict=True)
        nats = np.empty(len(grams))
        nats[order] = np.frombuffer(b"".join(n for _, n in sorted(pairs)), "<f4")
        sums, ends = np.r_[0, np.cumsum(nats[at])], offsets_of(lengths)
        totals, worst = np.diff(sums[ends]), worst_stretches(sums, ends)
        columns = [rows["chunk"], rows["place"], *map(pa.array, (totals, lengths, worst))]
        return pa.Table.from_arrays(columns, names=["chunk", "place", "nats", "n", "worst"])

    texts = table.select("chunk", "place", "text")
    by_chunk = texts.groupBy("chunk")
    trained = by_chunk.cogroup(trusted.groupBy("chunk")).applyInArrow(send_trusted, SENT)
    counts = keep(trained.groupBy("shard").applyInArrow(_counted, COUNTED), "gram-counts")
    asked = keep(by_chunk.applyInArrow(send, SENT), "asked-grams")
    needed = keep(
        asked.select("shard", "count", "grams", "uses").groupBy("shard").applyInArrow(_counted, COUNTED),
        "distinct-grams",
    )
    nats = needed.join(probabilities(counts, needed), "gram").select("shard", "gram", "nats")
    replies = asked.groupBy("shard").cogroup(nats.groupBy("shard")).applyInArrow(answer, REPLY)
    replies = keep(replies, "gram-nats")
    return by_chunk.cogroup(replies.groupBy("chunk")).applyInArrow(score, SCORED)


def _limits(tested: DataFrame) -> dict[str, tuple[int, float, float, float]]:
    """Held-out texts of each language, their median, threshold and worst stretch's threshold."""
    middles = (
        tested.groupBy("lang")
        .agg(
            F.count("*").alias("texts"),
            F.percentile_approx(F.col("nats") / F.col("n"), 0.5, 10_000).alias("middle"),
        )
        .orderBy(F.desc("texts"), "lang")
        .limit(MOST_LANGUAGES)
    )
    score = (F.col("nats") + PRIOR * F.col("middle")) / (F.col("n") + PRIOR)
    rows = (
        tested.join(F.broadcast(middles), "lang")
        .groupBy("lang", "texts", "middle")
        .agg(
            F.percentile_approx(score, QUANTILE, 10_000).alias("high"),
            F.percentile_approx("worst", [0.5, QUANTILE], 10_000).alias("worst"),
        )
        .collect()
    )
    return {
        r["lang"]: (
            r["texts"],
            r["middle"],
            widened(r["texts"], r["middle"], r["high"]),
            widened(r["texts"], *r["worst"], slack=FEW),
        )
        for r in rows
    }


def widened(texts: int, middle: float, high: float, slack: int = 0) -> float:
    """The quantile, moved out by what share of one text lies above it, and by ``slack`` times
    one text's share more: the highest of a few texts says little. From 100 texts on it is the
    quantile itself."""
    missing = max(0.0, 1 - texts * (1 - QUANTILE))
    return high + missing * (1 + slack / texts) * (high - middle)


def shrunk(
    own: tuple[int, float, float, float] | None, every: tuple[int, float, float, float]
) -> tuple[float, float, float]:
    """A language's values, drawn to those of all languages by the weight of ``FEW`` texts."""
    texts = own[0] if own else 0
    share = texts / (texts + FEW)
    values = own[1:] if own else every[1:]
    return tuple(share * a + (1 - share) * b for a, b in zip(values, every[1:], strict=True))


def judge_documents(
    docs: DataFrame,
    labels: DataFrame,
    columns: list[str] | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """The given columns of every row, with ``perplexity``, ``threshold`` and ``accepted``.

    ``labels`` are ``doc_id, quality, toxic``: trusted are documents of quality 1 that are not
    toxic. Given columns with the results' names are replaced.
    """
    spark = docs.sparkSession
    columns = [c for c in (columns or docs.columns) if c not in RESULTS]
    carried = [F.col(f"`{name}`").alias(f"c{n}") for n, name in enumerate(columns)]
    named = [F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.col(text).alias("text")]
    table = chunked(docs.select(*named, *carried), CHUNK_BYTES)
    good = (
        labels.filter("doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("toxic").alias("toxic"))
        .filter("quality = 1 AND coalesce(toxic, 0) = 0")
    )
    held = F.pmod(F.xxhash64("doc_id"), F.lit(HELD_OUT)) == 0
    trusted = keep(
        table.select("chunk", "place", "doc_id", "lang")
        .join(good.select("doc_id"), "doc_id")
        .select("chunk", "place", "lang", held.alias("held")),
        "trusted",
    )
    shards = int(spark.conf.get("spark.sql.shuffle.partitions"))
    scores = keep(_scores(table, trusted.filter("NOT held"), shards), "scores")
    # Thresholds, from held-out trusted texts.
    tested = trusted.filter("held").join(scores.filter("n > 0"), ["chunk", "place"])
    tested = keep(tested.drop("chunk", "place", "held"), "held-out")
    every = _limits(tested.withColumn("lang", F.lit(""))).get("")
    limits = _limits(tested.filter("lang IS NOT NULL")) if every else {}
    limits = {name: shrunk(own, every) for name, own in limits.items()}
    rest = every[1:] if every else None

    def attach(key: tuple, rows: pa.Table, scored: pa.Table) -> pa.Table:
        found = dict(
            zip(
                scored["place"].to_pylist(),
                zip(*(scored[name].to_pylist() for name in ("nats", "n", "worst")), strict=True),
                strict=True,
            )
        )
        perplexity, threshold, accepted = [], [], []
        for place, name in zip(rows["place"].to_pylist(), rows["lang"].to_pylist(), strict=True):
            nats, n, worst = found[place]
            middle, high, most = limits.get(name, rest) or (None, None, None)
            score = None
            if n:
                score = nats / n if middle is None else (nats + PRIOR * middle) / (n + PRIOR)
            perplexity.append(None if score is None else float(np.exp(min(score, 700))))
            threshold.append(None if high is None else float(np.exp(high)))
            within = high is None or (score is not None and score <= high and worst <= most)
            accepted.append(score is not None and within)
        results = [pa.array(perplexity, pa.float64()), pa.array(threshold, pa.float64())]
        results.append(pa.array(accepted, pa.bool_()))
        given = [rows[f"c{n}"] for n in range(n_columns)]
        names = [*(f"c{n}" for n in range(n_columns)), "perplexity", "threshold", "accepted"]
        return pa.Table.from_arrays([*given, *results], names=names)

    n_columns = len(columns)
    out = T.StructType(
        [
            *(table.schema[f"c{n}"] for n in range(n_columns)),
            T.StructField("perplexity", T.DoubleType()),
            T.StructField("threshold", T.DoubleType()),
            T.StructField("accepted", T.BooleanType()),
        ]
    )
    rows = table.select("chunk", "place", "lang", *(f"c{n}" for n in range(n_columns)))
    done = rows.groupBy("chunk").cogroup(scores.groupBy("chunk")).applyInArrow(attach, out)
    back = [F.col(f"c{n}").alias(name) for n, name in enumerate(columns)]
    return done.select(*back, "perplexity", "threshold", "accepted")
