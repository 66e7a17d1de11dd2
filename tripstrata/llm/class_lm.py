"""Class-based bigram language model, with word classes found by exchange.

``P(w | v) = P(class(w) | class(v)) * P(w | class(w))``, over folded words and an end token per document.

* Every word that occurs ``LEAST`` times or more in the training documents is assigned to a class by the exchange
  algorithm: a word moves to the class that raises the likelihood of all class bigrams most. Only rarer words keep
  a class by their last two bytes; the end token has its own. Classes grow with the cube root of those words.
* Word bigrams are counted once and stored as left and right contexts by word. In each round every task finds the
  best class of its words against the class bigrams of the round before, and about half of the words that gain may
  move. A round that lowers the likelihood is taken back, and the next one moves fewer. So the classes do not
  depend on how rows are dealt to tasks.
* Emissions use the count of every word of the training documents. The exchanged words, and ``FREQUENT`` words at
  least, are sent to all executors (18 bytes each); a document's other words meet their counts in a join. So no
  word that stands in most documents is ever shuffled row by row.

Documents whose ``crc32(doc_id) % 10`` is 0 are held out; those without ``doc_id`` are not. NULL text is an
empty one, with an end token only. Rows may repeat; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstrata.llm import words as W
from tripstrata.llm.components import written

U64 = np.uint64
LEAST = 10
CLASSES = 32
TAIL = 64
FREQUENT = 1 << 17
ROUNDS = 8
ENOUGH = 0.002
SMOOTH = 0.1
END = U64(0x5EED)
_FLUSH = 1 << 21
_PAIRS = 1 << 20
_BUCKET = 1 << 18
_CELLS = 1 << 19
_NEAR = 1 << 16
_TABLE = 1 << 22
_LOOKED_UP = 1 << 16
_XLOGX = np.arange(_LOOKED_UP + 1) * np.log(np.maximum(np.arange(_LOOKED_UP + 1), 1))
_FOLD = np.arange(256)
_FOLD[65:91] += 32


def _tokens(texts: pa.LargeStringArray):
    """Hash, tail class and text of each token; each text ends with the end token, of class TAIL."""
    words = W.split(texts)
    h = W.hashes(words, fold=True)
    last = before = np.zeros(0, np.int64)
    if len(h):
        last = _FOLD[words.data[words.end - 1]]
        two = words.end - words.start > 1
        before = np.where(two, _FOLD[words.data[np.maximum(words.end - 2, 0)]], 0)
    tail = (last * 31 + before) * 0x9E3779B1 % (1 << 32) * TAIL >> 32
    n = words.count
    place = words.first[1:] + np.arange(len(n))
    hashes = np.empty(len(h) + len(n), U64)
    classes = np.empty(len(hashes), np.int64)
    own = np.ones(len(hashes), bool)
    own[place] = False
    hashes[own], classes[own] = h, tail
    hashes[place], classes[place] = END, TAIL
    return hashes, classes, np.repeat(np.arange(len(n)), n + 1), n + 1


def _summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys)
    begin = np.flatnonzero(np.diff(keys[order], prepend=~keys[order][:1]) != 0)
    return order[begin], np.add.reduceat(n[order], begin) if len(begin) else n[:0]


def _totals(keys: np.ndarray, n: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, all below ``cells``, and their sums; without sorting if a table of them is small."""
    if cells > _TABLE:
        at, total = _summed(keys, n)
        return keys[at], total
    total = np.bincount(keys, n, cells)
    at = np.flatnonzero(total)
    return at, total[at]


def _count_rows(batches):
    """Tokens and their numbers; what a task has seen twice is added up before it leaves."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = 0

    def flushed():
        h, c, n = (np.concatenate(x) for x in zip(*held, strict=True))
        at, total = _summed(h, n)
        return h[at], c[at], total

    for piece in W.pieces(batches):
        h, c, _, _ = _tokens(piece.column("text"))
        at, n = _summed(h, np.ones(len(h), np.int64))
        held.append((h[at], c[at], n))
        size += len(at)
        if size > _FLUSH:
            held[:] = [flushed()]
            if len(held[0][0]) > _FLUSH // 2:
                yield from _count_batches(*held.pop())
            size = sum(len(x[0]) for x in held)
    if held:
        yield from _count_batches(*flushed())


def _count_batches(h, c, n):
    for lo in range(0, len(h), 1 << 17):
        part = slice(lo, lo + (1 << 17))
        yield pa.RecordBatch.from_pydict(
            {"h": pa.array(h[part].view(np.int64)), "cls": pa.array(c[part], pa.int32()), "n": n[part]}
        )


class Lexicon:
    """Words sorted by hash, with their counts; those of at least ``LEAST`` have a symbol of their own."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray):
        order = np.argsort(hashes)
        self.sorted, self.counts = hashes[order], counts[order]
        self.order = order

    def __len__(self) -> int:
        return len(self.sorted)

    @property
    def free(self) -> np.ndarray:
        return (self.counts >= LEAST) & (self.sorted != END)

    def places(self, h: np.ndarray) -> np.ndarray:
        """The place of each hash, or -1."""
        if not len(self.sorted):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.sorted, h), len(self.sorted) - 1)
        return np.where(self.sorted[at] == h, at, -1)


def _symbols(words: Lexicon, h: np.ndarray, tail: np.ndarray) -> np.ndarray:
    place = words.places(h)
    own = place >= 0
    own[own] = words.free[place[own]]
    return np.where(own, place, len(words) + tail)


def _before(symbols: np.ndarray, lengths: np.ndarray, end: int) -> np.ndarray:
    """The symbol before each one; texts begin after an end token."""
    before = np.empty_like(symbols)
    before[1:] = symbols[:-1]
    before[(np.cumsum(lengths) - lengths)] = end
    return before


_PARTS = ("own", "other", "n")
_CONTEXTS = "bucket int, own binary, other binary, n binary"
_STORED = _CONTEXTS + ", left_own binary, left_other binary, left_n binary"


def _context_batch(bucket: np.ndarray, own: np.ndarray, other: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """A row for each bucket; sorted by bucket and ``own``, of which the steps are stored."""
    begin = np.flatnonzero(np.diff(bucket, prepend=-1))
    step = np.diff(own, prepend=0)
    step[begin] = own[begin]
    offsets = np.append(begin, len(own))
    arrays = [pa.array(bucket[begin], pa.int32())]
    for x, t in ((step, np.int32), (other, np.int32), (n, np.int64)):
        values = pa.py_buffer(np.ascontiguousarray(x, t))
        ends = pa.py_buffer((offsets * np.dtype(t).itemsize).astype(np.int32))
        arrays.append(pa.Array.from_buffers(pa.binary(), len(begin), [None, ends, values]))
    return pa.RecordBatch.from_arrays(arrays, names=["bucket", "own", "other", "n"])


def _rows(batches):
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


def _contexts(row, side: str = "") -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    own, other, n = (np.frombuffer(row[side + x], t) for x, t in zip(_PARTS, ("i4", "i4", "i8"), strict=True))
    return np.cumsum(own, dtype=np.int64), other.astype(np.int64), n


def _context_rows(words, buckets: int):
    """Counts of neighbours, ``own = 2 * (symbol // buckets) + side``: side 0 for what follows, 1 for what precedes.

    Symbols that cannot move have side 0 only.
    """

    def rows(batches):
        lexicon = words.value
        size = len(lexicon) + TAIL + 1
        held: list[tuple[np.ndarray, np.ndarray]] = []
        waiting = 0

        def flushed():
            keys, n = (np.concatenate(x) for x in zip(*held, strict=True))
            at, total = _summed(keys, n)
            held[:] = [(keys[at], total)]

        def packed():
            flushed()
            keys, n = held.pop()
            first, second = (x.astype(np.int32) for x in np.divmod(keys, size))
            del keys
            yield sided(first, second, n, 0)
            left = second < len(lexicon)
            if left.any():
                yield sided(second[left], first[left], n[left], 1)

        def sided(symbol, other, n, side):
            own, bucket = np.divmod(symbol, np.int32(buckets))
            at = np.argsort(bucket.astype(np.int64) << 32 | own)
            return _context_batch(bucket[at], own[at] * 2 + side, other[at], n[at])

        for piece in W.pieces(batches):
            h, tail, _, lengths = _tokens(piece.column("text"))
            symbols = _symbols(lexicon, h, tail)
            keys = _before(symbols, lengths, size - 1) * size + symbols
            at, n = _summed(keys, np.ones(len(keys), np.int64))
            held.append((keys[at], n))
            waiting += len(at)
            if waiting > _PAIRS:
                flushed()
                waiting = len(held[0][0])
                if waiting > _PAIRS // 2:
                    yield from packed()
                    waiting = 0
        if held:
            yield from packed()

    return rows


def _merged_rows(batches):
    """One row for each bucket; either side has columns of its own, of which the class bigrams need but one."""
    found: dict[int, list] = {}
    for row in _rows(batches):
        found.setdefault(row["bucket"], []).append(row)
    for bucket in list(found):
        parts = [_contexts(row) for row in found.pop(bucket)]
        own, other, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        columns = {"bucket": pa.array([bucket], pa.int32())}
        for side, name in enumerate(("", "left_")):
            here = own % 2 == side
            at, total = _summed(own[here] >> 1 << 32 | other[here], n[here])
            step = np.diff(own[here][at] >> 1, prepend=0).astype(np.int32)
            values = (step, other[here][at].astype(np.int32), total.astype(np.int64))
            columns |= {name + x: pa.array([v.tobytes()]) for x, v in zip(_PARTS, values, strict=True)}
        yield pa.RecordBatch.from_pydict(columns)


def _grid_rows(state, buckets: int):
    """How often one class follows another."""

    def rows(batches):
        of, size = state.value
        grid = np.zeros(size * size, np.int64)
        for row in _rows(batches):
            own, other, n = _contexts(row)
            pair = of[own * buckets + row["bucket"]].astype(np.int64) * size + of[other]
            grid += np.bincount(pair, n, len(grid)).astype(np.int64)
        at = np.flatnonzero(grid)
        for lo in range(0, len(at), 1 << 17):
            part = at[lo : lo + (1 << 17)]
            yield pa.RecordBatch.from_pydict({"pair": pa.array(part, pa.int64()), "n": grid[part]})

    return rows


def _f(x: np.ndarray) -> np.ndarray:
    """``x log x`` of counts; small ones are looked up, which takes half as long as logarithms."""
    out = _XLOGX[np.clip(x, 0, _LOOKED_UP).astype(np.int32)]
    large = x >= _LOOKED_UP
    if large.any():
        out[large] = x[large] * np.log(x[large])
    return out


def likelihood(grid: np.ndarray) -> float:
    return float(_f(grid).sum() - _f(grid.sum(axis=1)).sum() - _f(grid.sum(axis=0)).sum())


def best_classes(
    grid: np.ndarray, classes: int, now: np.ndarray, own: np.ndarray, side: np.ndarray, of: np.ndarray,
    n: np.ndarray, alone: np.ndarray,
) -> np.ndarray:
    """For each word the class among the first ``classes`` that suits it best, all others staying where they are.

    ``now`` is the class of each word, ``alone`` how often it follows itself. Entry e says that word ``own[e]`` is
    followed (side 0) or preceded (side 1) by other words of class ``of[e]`` ``n[e]`` times; sorted by word.
    """
    words, size = len(now), len(grid)
    free = np.arange(classes)
    here, row = np.arange(words), free[None, :]
    by_side = [grid.T[:, :classes].copy(), grid[:, :classes].copy()]
    logged = [_f(x) for x in by_side]
    near = np.zeros((2, words, classes))
    inner = of < classes
    near[side[inner], own[inner], of[inner]] = n[inner]
    gain = np.zeros((words, classes))
    movable = now < classes
    for k in (0, 1):
        at = np.flatnonzero(side == k)
        step = max(1, _NEAR // classes)
        for lo in range(0, len(at), step):
            e = at[lo : lo + step]
            w, d, c = own[e], of[e], n[e][:, None]
            x, fx = by_side[k][d], logged[k][d]
            a = now[w]
            # Take the word out of its class: its own row of cells, and its column where it is met.
            i = np.flatnonzero(a < classes)
            x[i, a[i]] -= n[e][i]
            same = np.flatnonzero(d == a)
            x[same] -= near[1 - k, w[same]]
            both = same[a[same] < classes]
            x[both, a[both]] -= alone[w[both]]
            fx[i, a[i]] = _f(x[i, a[i]])
            fx[same] = _f(x[same])
            y = _f(x + c) - fx
            i = np.flatnonzero(d < classes)
            y[i, d[i]] = 0.0
            begin = np.flatnonzero(np.diff(w, prepend=-1))
            gain[w[begin]] += np.add.reduceat(y, begin)
    both = near[0] + near[1] + alone[:, None]
    diagonal = np.broadcast_to(grid[free, free], (words, classes)).copy()
    a = now[movable]
    diagonal[here[movable], a] -= both[here[movable], a]
    gain += _f(diagonal + both) - _f(diagonal)
    for k, sums in enumerate((grid.sum(axis=1), grid.sum(axis=0))):
        mass = np.bincount(own[side == k], n[side == k], words) + alone
        held = np.broadcast_to(sums[free], (words, classes)).copy()
        held[here[movable], a] -= mass[movable]
        gain -= _f(held + mass[:, None]) - _f(held)
    best = np.argmax(gain, axis=1)
    stays = movable.copy()
    stays[movable] = gain[here[movable], best[movable]] <= gain[here[movable], a] + 1e-9
    return np.where(stays, now, best)


def _move_rows(state, grid, buckets: int, classes: int, turn: int, share: int):
    """Words that gain by another class, of those whose turn it is."""

    def rows(batches):
        of, size = state.value
        table = grid.value
        words = len(of) - TAIL - 1
        for row in _rows(batches):
            sides = [_contexts(row, name) for name in ("", "left_")]
            known = np.zeros(1 + max(int(own[-1]) if len(own) else 0 for own, _, _ in sides), bool)
            for own, _, _ in sides:
                known[own] = True
            numbers = np.flatnonzero(known)
            symbols = numbers * buckets + row["bucket"]
            due = symbols < words
            if share > 1:
                due &= W.mix(symbols.astype(U64) + U64(turn << 40)) % U64(share) == 0
            symbols = symbols[due]
            if not len(symbols):
                continue
            rank = np.full(len(known), -1)
            rank[numbers[due]] = np.arange(len(symbols))
            keys, counts, alone = [], [], np.zeros(len(symbols))
            for side, (own, other, n) in enumerate(sides):
                place = rank[own]
                itself = other == own * buckets + row["bucket"]
                if side == 0:
                    at = itself & (place >= 0)
                    alone = np.bincount(place[at], n[at], len(symbols))
                at = ~itself & (place >= 0)
                keys.append((place[at] * 2 + side) * size + of[other[at]])
                counts.append(n[at])
            key, total = _totals(np.concatenate(keys), np.concatenate(counts), len(symbols) * 2 * size)
            place, rest = np.divmod(key, 2 * size)
            side, cls = np.divmod(rest, size)
            # A few thousand words at a time bound the tables of words by classes.
            step = max(1, _CELLS // classes)
            for lo in range(0, len(symbols), step):
                hi = min(lo + step, len(symbols))
                e = slice(*np.searchsorted(place, [lo, hi]))
                now = of[symbols[lo:hi]].astype(np.int64)
                best = best_classes(
                    table, classes, now, place[e] - lo, side[e], cls[e], total[e].astype(float), alone[lo:hi]
                )
                moved = np.flatnonzero(best != now)
                yield pa.RecordBatch.from_pydict(
                    {
                        "symbol": pa.array(symbols[lo:hi][moved], pa.int32()),
                        "cls": pa.array(best[moved], pa.int32()),
                    }
                )

    return rows


def cluster(train: DataFrame, words: Lexicon, tail: np.ndarray, tokens: int) -> tuple[np.ndarray, int, np.ndarray]:
    """The class of every symbol, the number of classes found by exchange, and the class bigrams.

    The most frequent words begin as classes of their own, all others in the class of their ending; the first
    round places these.
    """
    context = train.sparkSession.sparkContext
    free = np.flatnonzero(words.free)
    classes = min(max(CLASSES, round(len(free) ** (1 / 3))), len(free))
    size = classes + TAIL + 1
    of = np.concatenate([classes + tail, classes + np.arange(TAIL + 1)]).astype(np.int32)
    first = free[np.lexsort((words.sorted[free], -words.counts[free]))][:classes]
    of[first] = np.arange(classes)
    buckets = max(8, tokens // _BUCKET)
    shared = context.broadcast(words)
    table = written(
        train.mapInArrow(_context_rows(shared, buckets), _CONTEXTS)
        .repartition(max(8, buckets // 2), "bucket")
        .mapInArrow(_merged_rows, _STORED),
        "word_contexts",
    )
    shared.destroy()

    def bigrams(state) -> np.ndarray:
        found = (
            table.select("bucket", *_PARTS)
            .mapInArrow(_grid_rows(state, buckets), "pair long, n long")
            .groupBy("pair")
            .agg(F.sum("n").alias("n"))
            .toPandas()
        )
        grid = np.zeros(size * size)
        grid[found["pair"].to_numpy(np.int64)] = found["n"].to_numpy(float)
        return grid.reshape(size, size)

    state = context.broadcast((of, size))
    grid = bigrams(state)
    reached, share = likelihood(grid), 1
    for turn in range(ROUNDS if classes else 0):
        sent = context.broadcast(grid)
        moves = table.mapInArrow(
            _move_rows(state, sent, buckets, classes, turn, share), "symbol int, cls int"
        ).toPandas()
        sent.destroy()
        tried = of.copy()
        tried[moves["symbol"].to_numpy(np.int64)] = moves["cls"].to_numpy(np.int32)
        next_state = context.broadcast((tried, size))
        next_grid = bigrams(next_state)
        rise = likelihood(next_grid) - reached
        if turn and rise < 0:
            next_state.destroy()
            share *= 2
            continue
        state.destroy()
        of, state, grid, reached = tried, next_state, next_grid, reached + rise
        if turn and rise < ENOUGH * tokens / share:
            break
        share = max(share, 2)
    state.destroy()
    return of, classes, grid


def exchange(counts: np.ndarray, core: int, classes: int, sweeps: int = 30) -> np.ndarray:
    """The class of each of the first ``core`` symbols; the others keep classes of their own. One word moves at a
    time: for tables that one machine holds, and to compare ``best_classes`` with.

    ``counts[v, w]`` is how often w follows v. Raises the sum of ``f(N(c, d)) - f(N(c)) - f(N(d))`` over class
    bigrams, with ``f(x) = x log x``.
    """

    def f(x):
        return x * np.log(np.maximum(x, 1))

    others = len(counts) - core
    of = np.concatenate([np.arange(core) % classes, classes + np.arange(others)])
    size = classes + others
    counts = counts.astype(np.float64)

    def by_class(table):
        out = np.zeros((len(table), size))
        np.add.at(out.T, of, table.T)
        return out

    right, left = by_class(counts), by_class(counts.T)
    grid = np.zeros((size, size))
    np.add.at(grid, of, right)
    free = np.arange(classes)
    for _ in range(sweeps):
        moved = 0
        for w in range(core):
            a, alone = of[w], counts[w, w]
            r, l = right[w].copy(), left[w].copy()
            if not r.any() and not l.any():
                continue
            r[a] -= alone
            l[a] -= alone
            grid[a] -= r
            grid[:, a] -= l
            grid[a, a] -= alone
            out, into = grid.sum(axis=1), grid.sum(axis=0)
            rows, columns = grid[free], grid.T[free]
            gain_r, gain_l = f(rows + r) - f(rows), f(columns + l) - f(columns)
            gain = gain_r.sum(axis=1) + gain_l.sum(axis=1)
            gain -= gain_r[free, free] + gain_l[free, free]
            own = grid[free, free]
            gain += f(own + r[free] + l[free] + alone) - f(own)
            n_r, n_l = r.sum() + alone, l.sum() + alone
            # The classes of w's neighbours lose and win no mass by the move.
            gain -= f(out[free] + n_r) - f(out[free]) + f(into[free] + n_l) - f(into[free])
            b = int(np.argmax(gain))
            if gain[b] <= gain[a] + 1e-9:
                b = a
            grid[b] += r
            grid[:, b] += l
            grid[b, b] += alone
            if b != a:
                moved += 1
                of[w] = b
                right[:, a] -= counts[:, w]
                right[:, b] += counts[:, w]
                left[:, a] -= counts[w]
                left[:, b] += counts[w]
        if not moved:
            break
    return of


def _score_rows(model):
    """A row per document, and one per document and word that is not among the frequent ones."""

    def rows(batches):
        m = model.value
        for piece in W.pieces(batches):
            h, tail, doc, lengths = _tokens(piece.column("text"))
            place = m["words"].places(h)
            known = place >= 0
            symbols = m["fallback"] + tail
            symbols[known] = m["class_of"][place[known]]
            before = _before(symbols, lengths, m["fallback"] + TAIL)
            count = np.where(known, m["words"].counts[place] if len(m["words"]) else 0, 0) + SMOOTH
            emits = np.where(symbols < m["fallback"] + TAIL, np.log10(count / m["below"][symbols]), 0.0)
            score = m["moves"][before, symbols] + np.where(known, emits, 0.0)
            base = np.where(known, np.log10(count / m["norm"]), 0.0)
            docs = len(lengths)
            key = piece.column("key")
            yield _score_batch(
                key,
                piece.column("doc_id"),
                lengths,
                np.bincount(doc, known, docs).astype(np.int64),
                np.bincount(doc, base, docs),
                np.bincount(doc, score, docs),
                W.mix(key.to_numpy().view(U64)),
                np.full(docs, -1),
                np.zeros(docs, np.int64),
            )
            rare = np.flatnonzero(~known)
            at, n = _summed(W.mix(h[rare] ^ W.mix(doc[rare].astype(U64))), np.ones(len(rare), np.int64))
            rare = rare[at]
            key = pa.array(key.to_numpy()[doc[rare]])
            empty = np.zeros(len(rare))
            for lo in range(0, len(rare), 1 << 16):
                s = slice(lo, lo + (1 << 16))
                k = len(rare[s])
                yield _score_batch(
                    key[s], pa.nulls(k, pa.int64()), empty[s], empty[s], empty[s], empty[s],
                    h[rare[s]], tail[rare[s]], n[s],
                )

    return rows


_SCORES = "key doc_id n_tokens n_known base score h cls n".split()


def _score_batch(key, doc_id, n_tokens, n_known, base, score, h, cls, n) -> pa.RecordBatch:
    columns = [
        key,
        doc_id.cast(pa.int64()),
        pa.array(n_tokens.astype(np.int64)),
        pa.array(n_known.astype(np.int64)),
        pa.array(base),
        pa.array(score),
        pa.array(h.view(np.int64)),
        pa.array(cls.astype(np.int32)),
        pa.array(n),
    ]
    return pa.RecordBatch.from_arrays(columns, names=_SCORES)


def _frequent(counts: DataFrame) -> DataFrame:
    """The words of at least ``LEAST``, and those whose count is in the highest bands that together hold at most
    ``FREQUENT`` words.

    Bands are 16 to a doubling, so a few hundred rows tell where to stop, and no task sends more
    than its share of what is kept.
    """
    band = F.floor(F.log2("c") * 16)
    sizes = counts.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("n")).collect()
    held, least = 0, None
    for row in sorted(sizes, reverse=True):
        held += row["n"]
        if held > FREQUENT:
            break
        least = row["band"]
    kept = F.col("c") >= LEAST
    return counts.where(kept | (band >= least) if least is not None else kept)


def score_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, log10_perplexity``."""
    spark = docs.sparkSession
    plain = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col(text).cast("string").alias("text"),
        F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(False)).alias("held_out"),
    )
    train = plain.where(~F.col("held_out")).select("text")
    counts = written(
        train.mapInArrow(_count_rows, "h long, cls int, n long")
        .groupBy("h", "cls")
        .agg(F.sum("n").alias("c")),
        "word_counts",
    )
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    frequent = _frequent(counts).toPandas()
    words = Lexicon(frequent["h"].to_numpy(np.int64).view(U64), frequent["c"].to_numpy(np.int64))
    tail = frequent["cls"].to_numpy(np.int64)[words.order]
    del words.order
    of, classes, table = cluster(train, words, tail, int(total))
    size = len(table)
    moves = np.log10((table + SMOOTH) / (table.sum(axis=1, keepdims=True) + SMOOTH * size))

    # Tokens and distinct words of every class: exchanged words in theirs, the others by their tail.
    tails = counts.groupBy("cls").agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).toPandas()
    mass, kinds = np.zeros(size), np.zeros(size)
    np.add.at(mass, classes + tails["cls"].to_numpy(int), tails["c"].to_numpy(float))
    np.add.at(kinds, classes + tails["cls"].to_numpy(int), tails["v"].to_numpy(float))
    of = of[: len(words)]
    for sign, where in ((-1, classes + tail), (1, of)):
        np.add.at(mass, where, sign * words.counts.astype(float))
        np.add.at(kinds, where, sign)
    below = mass + SMOOTH * (kinds + 1)
    norm = total + SMOOTH * (distinct + 1)
    model = spark.sparkContext.broadcast(
        {
            "words": words,
            "class_of": of.astype(np.int32),
            "fallback": classes,
            "moves": moves,
            "below": below,
            "norm": norm,
        }
    )
    scored = plain.withColumn("key", F.monotonically_increasing_id()).select("key", "doc_id", "text")
    parts = scored.mapInArrow(
        _score_rows(model),
        "key long, doc_id long, n_tokens long, n_known long, base double, score double, "
        "h long, cls int, n long",
    )
    found = parts.join(counts, ["h", "cls"], "left")
    share = F.coalesce("c", F.lit(0)) + SMOOTH
    of_class = F.element_at(F.array(*[F.lit(float(x)) for x in below[classes:]]), F.col("cls") + 1)
    rare = F.col("cls") >= 0
    summed = found.groupBy("key").agg(
        F.max("doc_id").alias("doc_id"),
        F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.col("n_known") + F.when(rare & F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias(
            "n_known"
        ),
        F.sum(
            F.col("base") + F.when(rare, F.col("n") * F.log10(share / F.lit(float(norm)))).otherwise(0.0)
        ).alias("base_score"),
        F.sum(F.col("score") + F.when(rare, F.col("n") * F.log10(share / of_class)).otherwise(0.0)).alias(
            "score"
        ),
    )
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(False))
    return summed.select(
        "doc_id",
        held_out.alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(int(total)).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        (-F.col("score") / F.col("n_tokens")).alias("log10_perplexity"),
    )
