"""Language identification by cross-parsing entropy.

Training: for each language, words of a bounded sample of its labelled texts (TRAIN_TEXTS texts of the smallest id
hashes, SAMPLE_CHARS characters) are joined into one text, and its suffix automaton is built. Prediction: every word is
parsed into phrases, each the longest match that the language's text has anywhere, or one unknown character. A phrase
costs the logarithm of the number of places it may point to, log2 of the sample's length; the cost per character is the
cross-parsing entropy, and the language with the lowest one wins, so with samples of one length the one with the fewest
phrases. Phrases end at word ends, so that a word is parsed once per slice of texts, however often it occurs.

Only words with a letter count, lower-cased, with their other characters removed. Texts that are null or have no letter
get ``und`` with score 0; so does every text if nothing was learnt. Of languages with equal cost the one
with more labelled texts wins, then the first in alphabetical order. The score is 1 less the ratio of the winner's cost to the next one's; 1 if it is the only one.
Labels that are null are not learnt from; repeated rows are predicted one by one.

All labels are learnt. Sampled rows are chosen by their file and row, so that any number of rows of one id, or without one, give
no more than TRAIN_TEXTS. The automata are built in tasks, a language each, and written. Automata of BLOCK_BYTES are held at once;
with more, all texts are parsed against one block after the other, and the lowest and second lowest cost of each are brought
together.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ampline.llm.common import batches_of, documents, ship, string_column, text_slices, with_fields
from ampline.llm.op9_dedup import located
from ampline.llm.words import split_words
from ampline.staging import stage

TRAIN_TEXTS = 200        # texts learnt from for each language, at most
SAMPLE_CHARS = 60_000    # characters of each language's automaton, at most
SHARES = 20              # texts that fill a sample, at least, if the language has so many
BLOCK_BYTES = 64 << 20   # of automata that are held at once; a language takes some 2 MB
BUILD_ROWS = 8           # languages sent to a worker at a time
BROADCAST_ROWS = 400_000  # labels or chosen ids that are sent to all executors, at most
HELD_OUT = (4, 2)        # a document is held out if crc32 of its id modulo the first is the second
UNDECIDED = "und"
AUTOMATA = "lang string, n bigint, keys binary, targets binary, alphabet binary, phrase_bits double, size bigint"
NOT_LETTERS = r"[^\pL\pM]+"


@dataclass
class Automaton:
    """Suffix automaton: transitions by sorted key (state * symbols + symbol), and the cost of a phrase in bits."""

    keys: np.ndarray
    targets: np.ndarray
    phrase_bits: float


@dataclass
class Model:
    """The languages of one block."""

    languages: list[str]
    automata: list[Automaton]
    alphabets: list[np.ndarray]  # of each language, sorted code points; a code point's symbol is its place there


def build_automaton(symbols: list[int], n_symbols: int) -> Automaton:
    """The suffix automaton of a text, online (Blumer et al., 1985)."""
    links, lengths, moves, last = [-1], [0], [{}], 0
    for symbol in symbols:
        state = len(moves)
        moves.append({})
        lengths.append(lengths[last] + 1)
        links.append(0)
        p = last
        while p >= 0 and symbol not in moves[p]:
            moves[p][symbol] = state
            p = links[p]
        if p >= 0:
            q = moves[p][symbol]
            if lengths[q] == lengths[p] + 1:
                links[state] = q
            else:
                copy = len(moves)
                moves.append(dict(moves[q]))
                lengths.append(lengths[p] + 1)
                links.append(links[q])
                while p >= 0 and moves[p].get(symbol) == q:
                    moves[p][symbol] = copy
                    p = links[p]
                links[q] = links[state] = copy
        last = state
    keys = np.array([s * n_symbols + c for s, out in enumerate(moves) for c in out], np.int64)
    targets = np.array([t for out in moves for t in out.values()], np.int64)
    order = np.argsort(keys)
    return Automaton(keys[order], targets[order], float(np.log2(max(2, len(symbols)))))


def letters(words: pa.Array) -> pa.Array:
    """Words in lower case without what is no letter or mark; empty for words without any letter."""
    bare = pc.utf8_lower(pc.replace_substring_regex(words, NOT_LETTERS, ""))
    return pc.if_else(pc.match_substring_regex(bare, r"\pL"), bare, "")


def code_points(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all words and the number by word."""
    flat = "".join(words.to_pylist()).encode("utf-32-le")
    return np.frombuffer(flat, "<u4").astype(np.int64), np.asarray(pc.utf8_length(words), np.int64)


def count_phrases(automaton: Automaton, n_symbols: int, symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Phrases of each word; all words move on by one character at a time. Unknown symbols are -1."""
    starts = np.cumsum(lengths) - lengths
    phrases = (lengths > 0).astype(np.int64)
    alive = np.flatnonzero(lengths)
    state = np.zeros(len(alive), np.int64)
    keys, targets = automaton.keys, automaton.targets
    depth = 0
    while len(alive):
        symbol = symbols[starts[alive] + depth]

        def move(states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
            wanted = np.where(symbols < 0, -1, states * n_symbols + symbols)
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            return np.where(keys[at] == wanted, targets[at], -1)

        after = move(state, symbol)
        stuck = np.flatnonzero(after < 0)
        phrases[alive[stuck]] += state[stuck] > 0  # the phrase so far ends; in the root state none has begun
        again = move(np.zeros(len(stuck), np.int64), symbol[stuck])
        unknown = again < 0  # such a character is a phrase of its own, and the next one begins another
        phrases[alive[stuck[unknown]]] += lengths[alive[stuck[unknown]]] > depth + 1
        after[stuck] = np.maximum(again, 0)
        depth += 1
        going = lengths[alive] > depth
        alive, state = alive[going], after[going]
    return phrases


def is_held_out(doc_id) -> F.Column:
    modulo, left = HELD_OUT
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulo == left, F.lit(False))


def _sent(rows: DataFrame) -> DataFrame:
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def training_sample(docs: DataFrame) -> DataFrame:
    """lang, n (labelled texts), place, text: at most TRAIN_TEXTS rows of each label, by hash of the id and the row's place.

    Rows are chosen without reading texts, and thinned by hash before they are ranked, so that a language with most of the
    rows sends few to its rank.
    """
    at = F.col("locator")["at"]
    rows = located(docs)[0].select("locator", "row.doc_id", "row.text", "row.lang")
    labelled = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~is_held_out(F.col("doc_id")))
    sizes = stage(labelled.groupBy(F.col("lang").alias("known")).agg(F.count(F.lit(1)).alias("n")), "language-sizes")
    draw = F.pmod(F.xxhash64("doc_id", at), F.lit(1 << 30)) / (1 << 30)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id", at), "doc_id", "locator"))
    chosen = labelled.select("lang", "doc_id", "locator").join(_sent(sizes), F.col("lang") == F.col("known"))
    chosen = chosen.where(draw < 1.5 * TRAIN_TEXTS / F.col("n")).withColumn("rank", rank).where(F.col("rank") <= TRAIN_TEXTS)
    chosen = stage(chosen.select(F.col("locator").alias("chosen"), "n"), "language-rows")
    return labelled.join(_sent(chosen), F.col("locator") == F.col("chosen")).select(
        "lang", "n", F.xxhash64("doc_id", at).alias("place"), F.substring("text", 1, SAMPLE_CHARS).alias("text")
    )


@dataclass
class Trained:
    """The automata as a table, and its languages in blocks, those with more labelled texts first."""

    table: DataFrame
    blocks: list[list[str]]

    def model(self, block: int) -> Model:
        """The automata of a block, at most BLOCK_BYTES or one language."""
        if not self.blocks:
            return Model([], [], [])
        rows = {r.lang: r for r in self.table.where(F.col("lang").isin(self.blocks[block])).collect()}
        held = [rows[lang] for lang in self.blocks[block]]
        whole = lambda data: np.frombuffer(data, np.int64)
        return Model(
            [r.lang for r in held], [Automaton(whole(r.keys), whole(r.targets), r.phrase_bits) for r in held],
            [whole(r.alphabet) for r in held],
        )


def learnt_text(texts: list[str]) -> str:
    """The distinct words of a language's texts, in order, one on a line."""
    known: dict[str, None] = {}
    for text in texts:
        known.update(dict.fromkeys(letters(split_words(pa.array([text])).distinct).to_pylist()))
    return ("\n".join(w for w in known if w) + "\n")[:SAMPLE_CHARS]


def _built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From the sampled texts of each language its automaton; none of a language without letters."""
    kinds = [pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.int64()]
    names = [x.split()[0] for x in AUTOMATA.split(", ")]
    for batch in batches:
        rows = []
        for lang, n, texts in zip(*(column.to_pylist() for column in batch.columns)):
            text = learnt_text([t["text"] for t in texts])
            if text.strip():
                alphabet = sorted(set(map(ord, text)))
                symbol = {c: i for i, c in enumerate(alphabet)}
                made = build_automaton([symbol[ord(c)] for c in text], len(alphabet))
                parts = [x.astype(np.int64).tobytes() for x in (made.keys, made.targets, np.array(alphabet))]
                rows.append((lang, n, *parts, made.phrase_bits, sum(map(len, parts))))
        columns = zip(*rows) if rows else [[]] * len(kinds)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def train(sample: DataFrame) -> Trained:
    """Build the automata in tasks, a language in one, from at most TRAIN_TEXTS / SHARES * SAMPLE_CHARS characters each.

    Every text gives an equal share of its language's sample, as far as it has one, so that a few long or copied texts
    don't fill it, and a larger one if the language has few texts; words that a language's texts have once are as good as
    frequent ones, and each is taken once.
    """
    spark = sample.sparkSession
    ship(spark)
    texts = sample.groupBy(F.col("lang").alias("of")).agg(F.count_distinct(F.xxhash64("text")).alias("texts"))
    share = F.floor(SAMPLE_CHARS / F.least("texts", F.lit(SHARES))).cast("int")
    rows = sample.join(_sent(texts), F.col("lang") == F.col("of"))
    rows = rows.select("lang", "n", "place", F.substring("text", F.lit(1), share).alias("text")).dropDuplicates(["lang", "text"])
    by_language = rows.groupBy("lang", "n").agg(F.sort_array(F.collect_list(F.struct("place", "text"))).alias("texts"))
    with batches_of(spark, BUILD_ROWS):
        table = stage(by_language.mapInArrow(_built, AUTOMATA), "automata")
    blocks, room = [], 0
    for row in table.select("lang", "n", "size").orderBy(F.desc("n"), "lang").collect():  # one row per label
        if room < row.size:
            blocks.append([])
            room = BLOCK_BYTES
        blocks[-1].append(row.lang)
        room -= row.size
    return Trained(table, blocks)


def lowest(model: Model, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Of each text, the language of lowest cost, that cost and the second lowest; infinite if there is none."""
    words = split_words(texts)
    bare = letters(words.distinct)
    points, lengths = code_points(bare)

    def totals(by_word: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate(([0], np.cumsum(by_word[words.codes])))[words.bounds])

    def cost(automaton: Automaton, alphabet: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(alphabet, points), len(alphabet) - 1)
        symbols = np.where(alphabet[at] == points, at, -1)
        return totals(count_phrases(automaton, len(alphabet), symbols, lengths)) * automaton.phrase_bits

    none = np.full(len(texts), np.inf)
    if not model.languages:
        return [UNDECIDED] * len(texts), none, none
    costs = np.stack([cost(*x) for x in zip(model.automata, model.alphabets)])
    decided = totals(lengths) > 0
    names = [model.languages[b] if d else UNDECIDED for b, d in zip(costs.argmin(axis=0).tolist(), decided.tolist())]
    second = np.sort(costs, axis=0)[1] if len(costs) > 1 else none
    return names, np.where(decided, costs.min(axis=0), np.inf), np.where(decided, second, np.inf)


def predict(docs: DataFrame, trained: Trained) -> DataFrame:
    """doc_id, lang_pred and score of every row; only the text is looked at."""
    ship(docs.sparkSession)
    context = docs.sparkSession.sparkContext
    some = len(trained.blocks) > 1
    rows = docs.select("doc_id", "text")
    if some:
        rows = stage(rows.withColumn("at", F.monotonically_increasing_id()), "language-texts")  # fixes ``at``

    def parsed(block: int) -> tuple[DataFrame, object]:
        shared = context.broadcast(trained.model(block))  # at most BLOCK_BYTES, or one language

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in text_slices(batches):
                names, low, second = lowest(shared.value, string_column(batch.column(1)))
                keys = {n: batch.column(i) for i, n in enumerate(batch.schema.names) if n != "text"}
                yield pa.RecordBatch.from_pydict(keys | {"lang_pred": pa.array(names, pa.string()), "low": pa.array(low), "second": pa.array(second)})

        keys = rows.drop("text")
        return rows.mapInArrow(run, with_fields(keys, "lang_pred string, low double, second double")), shared

    if some:
        tables = []
        for block in range(len(trained.blocks)):
            table, shared = parsed(block)
            tables.append(stage(table.withColumn("block", F.lit(block)), f"language-costs-{block}"))
            shared.unpersist()
        every = reduce(DataFrame.unionByName, tables)
        ranked = F.array_sort(F.collect_list(F.struct("low", "block", "lang_pred", "second")))  # one entry a block
        best = every.groupBy("at").agg(F.first("doc_id").alias("doc_id"), ranked.alias("best"))
        found = best.select("doc_id", F.col("best")[0]["lang_pred"].alias("lang_pred"), F.col("best")[0]["low"].alias("low"),
                            F.least(F.col("best")[0]["second"], F.col("best")[1]["low"]).alias("second"))
    else:
        found, _ = parsed(0)
    # Infinity over infinity is no number, of texts without a language.
    score = F.when(F.col("second") == float("inf"), 1.0).otherwise(
        F.greatest(F.lit(0.0), 1 - F.col("low") / F.greatest("second", F.lit(1e-9)))
    )
    return found.select("doc_id", "lang_pred", F.when(F.col("low") == float("inf"), 0.0).otherwise(score).alias("score"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    model = train(stage(training_sample(docs), "language-sample"))
    return predict(docs, model).select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
