"""Best-fit packing by a grouping genetic algorithm on islands.

Documents become token ids and an end mark; only those longer than a sequence are cut. Full pieces
are sequences of their own. The others are dealt by hash into blocks of a few thousand pieces, each
a bin-packing problem of bounded size. For each block, several islands evolve populations of
packings in separate tasks: crossover injects whole well-filled bins of one parent into the other,
bins that hold duplicates of injected pieces are removed, and the pieces displaced with them are
placed again by best fit, longest first. Islands begin with different orders, of which one
is that of falling length. After each epoch the best packing of an island migrates to the next one. A block whose
packing reaches the lower bound stops there.
"""

from __future__ import annotations

import base64
import json
import random
import re
import sys
import types
import zlib
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, stored, text_batches

CAPACITY = 2048
END = 0
TOKENIZER = "byte_bpe_50k.json"
#: The same vocabulary as ranks.
RANKS = {"byte_bpe_50k.json": "byte_bpe_50k.tiktoken"}
#: Pieces of a block, about; islands, epochs and packings of a population.
BLOCK, ISLANDS, EPOCHS, POPULATION = 4096, 3, 2, 6
#: Children without a bin gained after which an epoch ends.
PATIENCE = 12
#: By how much a first packing's order departs from falling length, per packing and island.
NOISE = 0.1
#: Characters of a word from which on the tokenizers library encodes the text.
LONG_WORD = 1000
#: Anything but ASCII, Latin letters and signs, and common punctuation.
_RARE = re.compile("[^\\t\\n\\r\\x20-\\x7e\\xa1-\\u024f\\u2010-\\u2027]")


class Ids:
    """Token ids of whole texts by a byte-level BPE of the tokenizers library, as uint32 bytes.

    With ``ranked``, plain texts are encoded by the same vocabulary as ranks, in a third of the time;
    :func:`ranks_agree` proves that this gives the same ids. Texts with special tokens, very long words
    or characters other than the proven ones are left to the tokenizers library.
    """

    def __init__(self, tokenizer: str = TOKENIZER, ranked: bool = True):
        import public_tokenizers
        from tokenizers import Tokenizer

        self.path = tokenizer if "/" in tokenizer else public_tokenizers.path(tokenizer)
        self.tokenizer = Tokenizer.from_file(self.path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.ranked = self.ranks = None
        if ranked and tokenizer in RANKS:
            import tiktoken

            with open(public_tokenizers.path(RANKS[tokenizer]), "rb") as f:
                self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self.ranked = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=self.ranks, special_tokens={})

    def __call__(self, text: str) -> bytes:
        plain = self.ranked and not _RARE.search(text) and not any(s in text for s in self.special)
        if plain and max(map(len, text.split()), default=0) <= LONG_WORD:
            ids = self.ranked.encode_ordinary(text)
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()


def _last_pair(token: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """What is left of a token's bytes by all merges of ranks below its own."""
    parts = [token[i : i + 1] for i in range(len(token))]
    while len(parts) > 2:
        at = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], 1 << 60))
        if ranks.get(parts[at] + parts[at + 1], 1 << 60) >= ranks[token]:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


@lru_cache
def ranks_agree(tokenizer: str) -> bool:
    """Whether ranks encode plain texts as the tokenizer's file does; checked once, on the driver.

    Both list the same tokens; each merge of the file makes the token of the next rank, of the two
    parts that lower ranks leave of its bytes, so both merge alike; and each plain character is split
    from, or joined with, letters, digits, signs and spaces alike.
    """
    ids = Ids(tokenizer)
    if not ids.ranked:
        return False
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves
    hidden = [b for b in range(256) if b not in set(shown)]
    byte = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
    raw = lambda token: bytes(byte[c] for c in token)
    with open(ids.path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocab = {t: i for t, i in model["vocab"].items() if t not in ids.special}
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    if {raw(t): i for t, i in vocab.items()} != ids.ranks or len(merges) != len(ids.ranks) - 256:
        return False
    for k, (a, b) in enumerate(merges):
        if ids.ranks.get(raw(a + b)) != 256 + k or _last_pair(raw(a + b), ids.ranks) != [raw(a), raw(b)]:
            return False
    plain = [c for c in map(chr, range(0x2028)) if not _RARE.match(c)]
    places = ("{0}", "a{0}", "{0}a", "1{0}", "{0}1", "!{0}", "{0}!", " {0}", "{0} ", "  {0}a", "'{0}", "a{0}{0}a")
    around = [place.format(c) for c in plain for place in places]
    own = ids.tokenizer.encode_batch(around, add_special_tokens=False)
    return all(ids.ranked.encode_ordinary(t) == x.ids for t, x in zip(around, own))


def ids_here(tokenizer: str, ranked: bool) -> Ids:
    """This process's encoder: a Python worker keeps it from task to task, in a module of its own."""
    held = sys.modules.setdefault("_stackrill_worker", types.ModuleType("_stackrill_worker")).__dict__
    if (tokenizer, ranked) not in held:
        held[tokenizer, ranked] = Ids(tokenizer, ranked)
    return held[tokenizer, ranked]


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: the first takes what full pieces leave over."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity
    return [(0, first)] * bool(first) + [(s, capacity) for s in range(first, n, capacity)]


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(rid, id, piece, start, length, ids_crc32[, ids]) for each piece; null texts are empty."""
    text_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    end, ranked = np.array([END], "<u4").tobytes(), ranks_agree(tokenizer)

    def pieces(batches):
        encode = ids_here(tokenizer, ranked)
        for batch in batches:
            index, out = [], {k: [] for k in ("piece", "start", "length", "ids_crc32", "ids")}
            for i, text in enumerate(batch.column("text").to_pylist()):
                raw = encode(text) + end
                for k, (start, length) in enumerate(cuts(len(raw) // 4, capacity)):
                    own = raw[4 * start : 4 * (start + length)]
                    index.append(i)
                    for name, value in (("piece", k), ("start", start), ("length", length), ("ids_crc32", zlib.crc32(own)), ("ids", own)):
                        out[name].append(value)
            base = batch.select(["rid", "id"]).take(pa.array(index, pa.int64()))
            kinds = {"piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(), "ids": pa.binary()}
            names = [k for k in out if ids or k != "ids"]
            yield pa.RecordBatch.from_arrays([*base.columns, *(pa.array(out[k], kinds[k]) for k in names)], ["rid", "id", *names])

    return rows.mapInArrow(pieces, f"rid long, id {kind.simpleString()}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * ids)


class Bins:
    """Bins under best fit: a bit for each free space that some bin has finds the tightest one."""

    def __init__(self, capacity: int):
        self.capacity, self.bins, self.free = capacity, [], []
        self.by_free: dict[int, list[int]] = {}
        self.mask = 0

    def _file(self, b: int) -> None:
        free = self.free[b]
        self.by_free.setdefault(free, []).append(b)
        self.mask |= 1 << free

    def add_bin(self, items: list[int], used: int) -> None:
        self.bins.append(items)
        self.free.append(self.capacity - used)
        self._file(len(self.bins) - 1)

    def best_fit(self, item: int, length: int) -> None:
        fits = self.mask >> length
        if not fits:
            self.add_bin([item], length)
            return
        free = length + (fits & -fits).bit_length() - 1
        same = self.by_free[free]
        b = same.pop()
        if not same:
            self.mask ^= 1 << free
        self.bins[b].append(item)
        self.free[b] = free - length
        self._file(b)


def fitness(bins: list[list[int]], lengths: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins are better; among equals, those with fuller and emptier bins."""
    return len(bins), -sum((sum(lengths[i] for i in b) / capacity) ** 2 for b in bins)


def crossover(a: list[list[int]], b: list[list[int]], lengths: list[int], capacity: int, rng: random.Random) -> list[list[int]]:
    """``a`` with about half of the well-filled bins of ``b`` injected whole."""
    fills = [sum(lengths[i] for i in x) for x in b]
    bar = sorted(fills)[len(fills) // 2]
    injected = [x for x, fill in zip(b, fills) if fill >= bar and rng.random() < 0.5]
    taken = {i for x in injected for i in x}
    child, displaced = Bins(capacity), []
    for x in injected:
        child.add_bin(list(x), sum(lengths[i] for i in x))
    for x in a:
        own = [i for i in x if i not in taken]
        if len(own) == len(x):
            child.add_bin(own, sum(lengths[i] for i in own))
        else:
            displaced += own
    for i in sorted(displaced, key=lambda i: (-lengths[i], i)):
        child.best_fit(i, lengths[i])
    return child.bins


def mutate(a: list[list[int]], lengths: list[int], capacity: int, rng: random.Random) -> list[list[int]]:
    """``a`` with its emptiest bins and a few others emptied and their pieces placed again."""
    order = sorted(range(len(a)), key=lambda k: sum(lengths[i] for i in a[k]))
    gone = set(order[: max(1, len(a) // 50)]) | set(rng.sample(order, max(1, len(a) // 50)))
    child = Bins(capacity)
    for k, x in enumerate(a):
        if k not in gone:
            child.add_bin(list(x), sum(lengths[i] for i in x))
    for i in sorted((i for k in gone for i in a[k]), key=lambda i: (-lengths[i], i)):
        child.best_fit(i, lengths[i])
    return child.bins


class Evolved(NamedTuple):
    """Best genomes (the bin of each piece), best first; crossovers made; bins before and after."""

    genomes: list[list[int]]
    crossovers: int
    before: int
    after: int


def evolve(lengths: list[int], capacity: int, genomes: list[list[int]], seed: int, island: int = 0, patience: int = PATIENCE, population: int = POPULATION) -> Evolved:
    """One island's epoch: crossover, at times mutation, until the bound or ``patience`` children
    without a bin gained.

    The population begins with ``genomes``, and else with best fit by orders that depart from falling
    length, each island's by more than the one before; only the first island has that order itself. A child takes the worst packing's place if it
    is better and like no other.
    """
    rng, bound = random.Random(seed), -(-sum(lengths) // capacity)
    score = lambda x: fitness(x, lengths, capacity)
    pop = [(score(bins), bins) for bins in map(_bins, genomes)]
    while len(pop) < population:
        noise, packed = NOISE * (island + len(pop)), Bins(capacity)
        for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i] * (1 + noise * rng.random()), i)):
            packed.best_fit(i, lengths[i])
        pop.append((score(packed.bins), packed.bins))
    pop.sort(key=lambda p: p[0])
    before, made, gained = pop[0][0][0], 0, 0
    while pop[0][0][0] > bound and made - gained < patience and population > 1:
        a, b = rng.sample(pop, 2)
        child = crossover(a[1], b[1], lengths, capacity, rng)
        if rng.random() < 0.3:
            child = mutate(child, lengths, capacity, rng)
        made, fit = made + 1, score(child)
        if fit < pop[-1][0] and all(fit != p[0] for p in pop):
            gained = made if fit[0] < pop[0][0][0] else gained
            pop = sorted([*pop[:-1], (fit, child)], key=lambda p: p[0])
    return Evolved([_genome(bins, len(lengths)) for _, bins in pop[:2]], made, before, pop[0][0][0])


def _bins(genome: list[int]) -> list[list[int]]:
    bins: dict[int, list[int]] = {}
    for i, b in enumerate(genome):
        bins.setdefault(b, []).append(i)
    return list(bins.values())


def _genome(bins: list[list[int]], n: int) -> list[int]:
    genome = [0] * n
    for k, items in enumerate(bins):
        for i in items:
            genome[i] = k
    return genome


def _place(genome: list[int], lengths: list[int]) -> list[int]:
    used: dict[int, int] = {}
    out = []
    for b, n in zip(genome, lengths):
        out.append(used.get(b, 0))
        used[b] = out[-1] + n
    return out


_STATE = pa.schema([("block", pa.int64()), ("island", pa.int32()), ("genome", pa.list_(pa.int32())), ("bins", pa.int32()), ("spread", pa.float64()), ("crossovers", pa.int32()), ("before", pa.int32())])


def evolved_blocks(pieces: DataFrame, temp: Scratch, capacity: int = CAPACITY, block: int = BLOCK, islands: int = ISLANDS, epochs: int = EPOCHS, patience: int = PATIENCE, population: int = POPULATION) -> tuple[DataFrame, list[DataFrame]]:
    """(block, items) of the pieces, and each epoch's packings (block, island, genome, bins, spread,
    crossovers, before): an island's best ones and the elite that came from the island before it."""
    n_blocks = max(1, round(pieces.count() / block))
    item = F.struct((-F.col("length")).alias("order"), *pieces.columns)
    dealt = pieces.groupBy(F.pmod(F.xxhash64("rid", "piece"), F.lit(n_blocks)).alias("block")).agg(F.array_sort(F.collect_list(item)).alias("items"))
    blocks = temp.stored(dealt, "pack-blocks")
    problems = blocks.select("block", F.col("items.length").alias("lengths"))
    state, found = problems.select("block", "lengths", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), F.array().cast("array<array<int>>").alias("genomes")), []
    for epoch in range(epochs):

        def run(batches, epoch=epoch):
            for batch in batches:
                rows = []
                for r in batch.to_pylist():
                    best = evolve(r["lengths"], capacity, r["genomes"], (r["block"] * islands + r["island"]) * epochs + epoch, r["island"], patience, population)
                    for g in best.genomes:
                        bins, spread = fitness(_bins(g), r["lengths"], capacity)
                        rows.append({"block": r["block"], "island": r["island"], "genome": g, "bins": bins, "spread": spread, "crossovers": best.crossovers, "before": best.before})
                    rows.append(rows[-len(best.genomes)] | {"island": (r["island"] + 1) % islands, "crossovers": 0})  # the elite migrates
                yield pa.RecordBatch.from_pylist(rows, _STATE)

        ran = state.select("block", "island", "lengths", "genomes").mapInArrow(run, "block long, island int, genome array<int>, bins int, spread double, crossovers int, before int")
        found.append(temp.stored(ran, f"pack-epoch-{epoch}"))
        state = found[-1].groupBy("block", "island").agg(F.collect_list("genome").alias("genomes")).join(problems, "block")
    return blocks, found


def pack(pieces: DataFrame, capacity: int = CAPACITY, **search: int) -> DataFrame:
    """``pieces`` (a stored table of :func:`token_pieces`) with sequence_id and offset.

    Pieces of full length get sequences of their own (negative numbers); no piece is longer.
    ``search`` goes to :func:`evolved_blocks`.
    """
    spark = pieces.sparkSession
    text_batches(spark)
    full = pieces.where(F.col("length") == capacity).select("*", (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))

    def place(batches):
        for batch in batches:
            lengths, genomes = batch.column("lengths").to_pylist(), batch.column("genome").to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("genome"), pa.array([_place(g, x) for g, x in zip(genomes, lengths)], pa.list_(pa.int64()))], ["block", "genome", "offsets"])

    with Scratch(spark) as temp:
        blocks, epochs = evolved_blocks(pieces.where(F.col("length") < capacity), temp, capacity, **search)
        best = epochs[-1].groupBy("block").agg(F.min_by("genome", F.struct("bins", "spread", "genome")).alias("genome"))
        problems = blocks.select("block", F.col("items.length").alias("lengths"))
        placed = best.join(problems, "block").mapInArrow(place, "block long, genome array<int>, offsets array<long>").join(blocks, "block")
        rows = placed.select("block", F.inline(F.arrays_zip("items", "genome", "offsets")))
        rows = stored(rows.select(*(F.col(f"items.{c}").alias(c) for c in pieces.columns), (F.col("block") * (1 << 24) + F.col("genome")).alias("sequence_id"), F.col("offsets").alias("offset")), "packed")
    return rows.unionByName(full)


def search_report(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, id_col: str = "doc_id", text_col: str = "text", **search: int) -> dict[str, int]:
    """What the search did on ``docs``: blocks, their bound on bins, bins of the best first packing, bins
    reached, and crossovers made."""
    with Scratch(docs.sparkSession) as temp:
        pieces = temp.stored(token_pieces(docs, capacity, tokenizer, False, id_col, text_col), "pack-pieces")
        blocks, epochs = evolved_blocks(pieces.where(F.col("length") < capacity), temp, capacity, **search)
        bound = F.ceil(F.aggregate("items", F.lit(0).cast("long"), lambda s, x: s + x["length"]) / float(capacity))
        first = epochs[0].groupBy("block").agg(F.min("before").alias("before"))
        last = epochs[-1].groupBy("block").agg(F.min("bins").alias("bins"))
        sums = blocks.select("block", bound.alias("bound")).join(first, "block").join(last, "block").agg(F.count(F.lit(1)), F.sum("bound"), F.sum("before"), F.sum("bins")).head()
        made = sum(e.dropDuplicates(["block", "island", "crossovers"]).agg(F.coalesce(F.sum("crossovers"), F.lit(0))).head()[0] for e in epochs)
    return dict(zip(("blocks", "bound", "before", "bins", "crossovers"), [*(x or 0 for x in sums), made]))


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset.

    Null and empty texts are one end mark. Repeated rows, also of one id, are packed each on its
    own. Other columns are not read. An empty table gives an empty one.
    """
    pieces = stored(token_pieces(docs, capacity, tokenizer, False, id_col, text_col), "pack-pieces")
    return pack(pieces, capacity).select(F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def packed_sequences(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The sequences themselves: sequence_id, ids (uint32 bytes, little-endian), ids of documents."""
    pieces = stored(token_pieces(docs, capacity, tokenizer, True, id_col, text_col), "pack-ids")
    placed = pack(pieces.drop("ids"), capacity).select("rid", "piece", "sequence_id", "offset")
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids", "id")))
    rows = pieces.join(placed, ["rid", "piece"]).groupBy("sequence_id").agg(parts.alias("parts"))
    return rows.select("sequence_id", F.array_join(F.transform("parts", lambda p: F.hex(p["ids"])), "").alias("hex"), F.col("parts.id").alias("docs")).select("sequence_id", F.unhex("hex").alias("ids"), "docs")


def op2_query(docs: DataFrame) -> DataFrame:
    """The digest of :func:`pack_documents` for each piece."""
    return pack_documents(docs)
