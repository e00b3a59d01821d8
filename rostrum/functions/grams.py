"""Counts of n-grams inside Arrow batches: combined before the shuffle, summed after it.

Rows between the two carry many terms each, one behind the other in a string with their lengths beside it, so that
a term costs its own bytes and not a row's.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: n-grams that are counted at once; a longer document is still counted as a whole.
PIECE_GRAMS = 1_500_000
_MIX = np.array([0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93], np.uint64)


def key_codes(columns: list[pa.Array], n: int) -> tuple[np.ndarray, np.ndarray]:
    """A dense number for each row's values, null being one of them, and a row of each number."""
    codes = np.zeros(n, np.int64)
    for c in columns:
        e = pc.dictionary_encode(c, null_encoding="encode")
        mixed = codes * max(1, len(e.dictionary)) + e.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        codes = np.unique(mixed, return_inverse=True)[1]
    _, first, codes = np.unique(codes, return_index=True, return_inverse=True)
    return codes, first


def buckets(terms: pa.Array, n: int) -> np.ndarray:
    """A number below ``n`` for each term, the same in every task."""
    return (hashes(terms) % np.uint64(n)).astype(np.int64)


def hashes(terms: pa.Array) -> np.ndarray:
    """64 bits from the bytes of each term, eight at a time."""
    terms = pa.concat_arrays([terms]).cast(pa.large_string())
    _, ends, data = terms.buffers()
    ends = np.frombuffer(ends, np.int64, len(terms) + 1)
    data = np.append(np.frombuffer(data, np.uint8, ends[-1]) if ends[-1] else np.zeros(0, np.uint8), np.zeros(8, np.uint8))
    words = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
    at, left = ends[:-1], np.diff(ends)
    out = left.astype(np.uint64) * _MIX[0]
    some = np.arange(len(terms))
    while len(some):
        here = words[at]
        short = left < 8
        here[short] &= (np.uint64(1) << (8 * left[short]).astype(np.uint64)) - np.uint64(1)
        h = (out[some] ^ here) * _MIX[1]
        out[some] = h ^ (h >> np.uint64(29))
        more = left > 8
        some, at, left = some[more], at[more] + 8, left[more] - 8
    out *= _MIX[0]
    return out ^ (out >> np.uint64(32))


def _next(h: np.ndarray, token: np.ndarray) -> np.ndarray:
    """Hashes of n-grams from those of the (n-1)-grams at the same places and of the tokens behind them."""
    h = (h * _MIX[0] ^ token) * _MIX[1]
    return h ^ (h >> np.uint64(31))


def term_hashes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each term, made of those of its tokens."""
    for batch in batches:
        tokens = pc.split_pattern(batch.column(0), " ")
        size = pc.list_value_length(tokens).to_numpy()
        for n in np.unique(size):
            of = tokens.filter(pa.array(size == n)).flatten()
            each = hashes(of).reshape(-1, n)
            h = each[:, 0]
            for i in range(1, n):
                h = _next(h, each[:, i])
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], names=["h"])


def _among(h: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(h), bool)
    return known[np.minimum(np.searchsorted(known, h), len(known) - 1)] == h


def known_grams(batches: Iterable[pa.RecordBatch], keys: list[str], lengths: tuple[int, int], known: np.ndarray | None, parts: bool) -> Iterator[pa.RecordBatch]:
    """Rows ``(*keys, term, cnt)`` of each row's n-grams, from rows ``(*keys, tokens)``; every term once a row.

    Left out are n-grams whose hash is not among the sorted ``known`` ones or, with ``parts``, that of one of their two
    (n-1)-grams is not. Equal hashes let some others through, so who calls this compares the terms.
    """
    for batch in batches:
        ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(batch.column(len(keys))), 0).to_numpy().astype(np.int64))])
        at = 0
        while at < len(batch):
            upto = max(at + 1, int(np.searchsorted(ends, ends[at] + PIECE_GRAMS // lengths[1], "right")) - 1)
            for columns in _known(batch.slice(at, upto - at), ends[at:upto + 1] - ends[at], keys, lengths, known, parts):
                yield from _output([*keys, "term", "cnt"], columns)
            at = upto


def _known(batch: pa.RecordBatch, ends: np.ndarray, keys: list[str], lengths: tuple[int, int], known: np.ndarray | None, parts: bool) -> Iterator[list[pa.Array]]:
    e = batch.column(len(keys)).flatten().dictionary_encode()
    code = e.indices.to_numpy().astype(np.int64)
    doc = np.repeat(np.arange(len(batch)), np.diff(ends))
    for terms, gram, of in _among_known(e.dictionary, code, doc, lengths, known, parts):
        pair = np.sort(gram * len(batch) + of)
        starts = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
        counts = np.diff(np.append(starts, len(pair)))
        pair = pair[starts]
        of = pa.array(pair % len(batch))
        yield [*[batch.column(i).take(of) for i in range(len(keys))], terms.take(pa.array(pair // len(batch))), pa.array(counts.astype(np.int64))]


def _among_known(tokens: pa.Array, code: np.ndarray, doc: np.ndarray, lengths: tuple[int, int], known: np.ndarray | None,
                 parts: bool) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """For each length the distinct n-grams that may be known, and the term and the row of each place of one."""
    token = hashes(tokens)[code]
    h = before = token
    for n in range(1, lengths[1] + 1):
        if n > len(code):
            return
        if n > 1:
            before, h = h, _next(h[:-1], token[n - 1:])
        if n < lengths[0]:
            continue
        there = doc[:len(h)] == doc[n - 1:]
        if known is not None and parts:
            sub = _among(before, known)
            there &= sub[:-1] & sub[1:]
        elif known is not None:
            there &= _among(h, known)
        at = np.flatnonzero(there)
        if not len(at):
            continue
        gram = code[at]
        for i in range(1, n):
            gram = np.unique(gram, return_inverse=True)[1] * len(tokens) + code[at + i]
        _, first, gram = np.unique(gram, return_index=True, return_inverse=True)
        words = [tokens.take(pa.array(code[at[first] + i])) for i in range(n)]
        yield pc.binary_join_element_wise(*words, " ") if n > 1 else words[0], gram, doc[at]


#: Bytes of text whose words are split at once.
PIECE_BYTES = 5_000_000


def table_of(bits: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool)


def split_words(texts: pa.Array, table: np.ndarray, least: int) -> tuple[pa.Array, np.ndarray]:
    """The runs of ``least`` or more characters that ``table`` (a bit for each code point) holds, and the row of each."""
    texts = pa.concat_arrays([pc.fill_null(texts, "")]).cast(pa.large_string())
    _, ends, data = texts.buffers()
    ends = np.frombuffer(ends, np.int64, len(texts) + 1 + texts.offset)[texts.offset:]
    data = np.frombuffer(data, np.uint8, ends[-1])[ends[0]:] if ends[-1] else np.zeros(0, np.uint8)
    ends = ends - ends[0]
    plain = np.zeros(256, bool)
    plain[:128] = table[:128]
    word = plain[data]
    high = np.flatnonzero(data >= 0xC0)
    if len(high):  # characters of several bytes
        lead = data[high].astype(np.int64)
        tail = [data[np.minimum(high + i, len(data) - 1)].astype(np.int64) & 63 for i in (1, 2, 3)]
        size = 2 + (lead >= 0xE0) + (lead >= 0xF0)
        code = np.where(size == 2, (lead & 31) << 6 | tail[0], np.where(
            size == 3, (lead & 15) << 12 | tail[0] << 6 | tail[1], (lead & 7) << 18 | tail[0] << 12 | tail[1] << 6 | tail[2]))
        held = table[np.minimum(code, len(table) - 1)]
        for i in range(4):
            at = high[held & (size > i)] + i
            word[at[at < len(data)]] = True
    edge = ends[ends < len(data)]
    before = np.append(False, word[:-1])[:len(word)]
    before[edge] = False
    start = np.flatnonzero(word & ~before)
    after = np.append(word[1:], False)[:len(word)]
    after[edge[edge > 0] - 1] = False
    stop = np.flatnonzero(word & ~after) + 1
    size = stop - start
    if least > 1:
        short = np.flatnonzero(size <= 4 * (least - 1))
        chars = sum(((start[short] + i < stop[short]) & ((data[np.minimum(start[short] + i, len(data) - 1)] & 0xC0) != 0x80)).astype(np.int64)
                    for i in range(4 * (least - 1)))
        short = short[chars < least]
        for i in range(4 * (least - 1)):
            word[start[short[size[short] > i]] + i] = False
        start, size = np.delete(start, short), np.delete(size, short)
    tokens = pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(np.append(0, np.cumsum(size))), pa.py_buffer(data[word]))
    return tokens, np.searchsorted(ends, start, side="right") - 1


def _split(batches: Iterable[pa.RecordBatch], text: int, table: np.ndarray, least: int) -> Iterator[tuple[pa.RecordBatch, pa.Array, np.ndarray, np.ndarray]]:
    """Pieces of batches with the distinct words of column ``text``, and the word and the row of each place."""
    for batch in batches:
        ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy().astype(np.int64))])
        at = 0
        while at < len(batch):
            upto = max(at + 1, int(np.searchsorted(ends, ends[at] + PIECE_BYTES, "right")) - 1)
            piece = batch.slice(at, upto - at)
            tokens, doc = split_words(piece.column(text), table, least)
            e = tokens.dictionary_encode()
            if len(tokens):
                yield piece, e.dictionary.cast(pa.string()), e.indices.to_numpy().astype(np.int64), doc
            at = upto


def word_stats(batches: Iterable[pa.RecordBatch], keys: list[str], words: list[str] | dict[str, list[str]], by: str, table: np.ndarray, least: int,
               n: int, known: np.ndarray | None, parts: int) -> Iterator[pa.RecordBatch]:
    """Rows ``(part, *keys, terms, sizes, counts)`` from rows ``(*keys, text)``: in how many rows each n-gram of ``n`` words is.

    The stop list goes out first; it is one list, or one for each value of the key ``by``. Longer n-grams are left out
    where the hash of one of their two (n-1)-grams is not among ``known``.
    """
    for batch, tokens, code, doc in _split(batches, len(keys), table, least):
        lists = words.items() if isinstance(words, dict) else [(None, words)]
        gone = np.zeros(len(code), bool)
        for value, stop in lists:
            out = pc.is_in(tokens, pa.array(list(stop), pa.string())).to_numpy(zero_copy_only=False)[code]
            if value is not None:
                out &= pc.fill_null(pc.equal(batch.column(keys.index(by)), value), False).to_numpy(zero_copy_only=False)[doc]
            gone |= out
        code, doc = code[~gone], doc[~gone]
        key, first = key_codes([batch.column(i) for i in range(len(keys))], len(batch))
        found = [(tokens, code, doc)] if n == 1 else _among_known(tokens, code, doc, (n, n), known, True)
        for terms, gram, of in found:
            if len(gram):
                yield from _by_part(batch, key, first, keys, terms, gram, of, True, parts)


class Vocabulary:
    """Terms of all groups, held in a task: the number of a term is its place in ``ids`` and ``sizes``."""

    def __init__(self, table: pa.Table, group: list[str]):
        table = table.combine_chunks()
        self.group, self.ids, self.sizes = group, table["term_id"].to_numpy().astype(np.int64), table["n"].to_numpy().astype(np.int64)
        e = pa.concat_arrays([pa.array([], pa.string()), *table["term"].chunks]).dictionary_encode()
        rows = list(zip(*[table[c].to_pylist() for c in group])) if group else [()] * len(table)
        self.groups = {g: i for i, g in enumerate(dict.fromkeys(r for r in rows if None not in r))}
        self.terms = e.dictionary
        self.number = np.full((len(self.groups) + 1, len(self.terms) + 1), -1, np.int64)
        of = np.array([self.groups.get(r, -1) for r in rows], np.int64)
        at = e.indices.to_numpy().astype(np.int64)
        there = np.flatnonzero(of >= 0)
        self.number[of[there], at[there]] = there
        self.unique = int((self.number >= 0).sum()) == len(there)

    def group_of(self, columns: list[pa.Array], n: int) -> np.ndarray:
        """The number of each row's group, -1 for others."""
        key, first = key_codes(columns, n)
        names = zip(*[c.take(pa.array(first)).to_pylist() for c in columns]) if columns else [()] * len(first)
        return np.array([self.groups.get(x, -1) for x in names], np.int64)[key]


def count_words(batches: Iterable[pa.RecordBatch], keys: list[str], table: np.ndarray, least: int, n_max: int, known: np.ndarray,
                vocab: Vocabulary) -> Iterator[pa.RecordBatch]:
    """Rows ``(*keys, terms, counts)`` from rows ``(*keys, text)``: the numbers of the vocabulary's terms in each row's text."""
    for batch, tokens, code, doc in _split(batches, len(keys), table, least):
        group = vocab.group_of([batch.column(keys.index(c)) for c in vocab.group], len(batch))
        found = []
        for terms, gram, of in _among_known(tokens, code, doc, (1, n_max), known, False):
            at = pc.fill_null(pc.index_in(terms, value_set=vocab.terms), -1).to_numpy().astype(np.int64)
            number = vocab.number[group[of], at[gram]]
            there = number >= 0
            found.append(of[there] * len(vocab.ids) + number[there])
        if found and sum(map(len, found)):
            pair = np.sort(np.concatenate(found))
            starts = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
            counts = np.diff(np.append(starts, len(pair)))
            pair = pair[starts]
            row = pair // len(vocab.ids)
            heads = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
            of = pa.array(row[heads])
            yield pa.RecordBatch.from_arrays([*[batch.column(i).take(of) for i in range(len(keys))], _lists(pair % len(vocab.ids), heads), _lists(counts, heads)],
                                             names=[*keys, "terms", "counts"])


#: Counts that a task holds before it sums those of equal keys.
HELD_COUNTS = 20_000_000


def _merged(batches: list[pa.RecordBatch], keys: list[str], width: int) -> tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rows of the keys, and of each sum the key, the term's number and the count."""
    table = pa.Table.from_batches(batches).combine_chunks()
    column = lambda c: table.column(c).chunk(0)
    key, first = key_codes([column(c) for c in keys], len(table))
    size = pc.list_value_length(column("terms")).to_numpy().astype(np.int64)
    pair = np.repeat(key, size) * width + column("terms").flatten().to_numpy().astype(np.int64)
    pair, n = _sum_by(pair, column("counts").flatten().to_numpy().astype(np.int64))
    return table.select(keys), first, pair // width, pair % width, n


def merge_counts(batches: Iterable[pa.RecordBatch], keys: list[str], vocab: Vocabulary) -> Iterator[pa.RecordBatch]:
    """Rows ``(*keys, term_id, n, cnt)`` of a partition that holds all rows of its documents."""
    held, cells, most = [], 0, HELD_COUNTS
    for batch in batches:
        if not len(batch):
            continue
        held.append(batch)
        cells += len(batch.column(len(keys)).flatten())
        if cells > most:
            table, first, key, number, n = _merged(held, keys, len(vocab.ids))
            heads = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            at = pa.array(first[key[heads]])
            lists = pa.LargeListArray.from_arrays(np.append(heads, len(key)), pa.array(n)).cast(batch.schema.field("counts").type)
            held = [pa.RecordBatch.from_arrays([*[table.column(c).chunk(0).take(at) for c in keys], _lists(number, heads), lists], names=batch.schema.names)]
            cells = len(key)
            most = max(HELD_COUNTS, 2 * cells)
    if held:
        table, first, key, number, n = _merged(held, keys, len(vocab.ids))
        at = pa.array(first[key])
        yield from _output([*keys, "term_id", "n", "cnt"], [
            *[table.column(c).chunk(0).take(at) for c in keys], pa.array(vocab.ids[number]), pa.array(vocab.sizes[number].astype(np.int32)), pa.array(n)])


class Overlaps:
    """The terms inside each n-gram, held in a task."""

    def __init__(self, table: pa.Table, group: list[str]):
        self.group = group
        rows = list(zip(*[table[c].to_pylist() for c in group])) if group else [()] * len(table)
        self.groups = {g: i for i, g in enumerate(dict.fromkeys(r for r in rows if None not in r))}
        owners = [(self.groups[r], t) if r in self.groups and t is not None else None for r, t in zip(rows, table["term_id"].to_pylist())]
        lists = [[(o, x) for o, xs in zip(owners, table[c].to_pylist()) if o for x in xs or ()] for c in ("pairs", "singles")]
        self.pairs = self._index([(*o, x["sub_id"], x["before"]) for o, x in lists[0]])
        self.singles = self._index([(*o, x["sub_id"], False) for o, x in lists[1]])

    @staticmethod
    def _index(rows: list[tuple]) -> dict[int, tuple[np.ndarray, ...]]:
        """For each group the sorted n-grams with the place of their first entry, and the entries."""
        a = np.array(rows, np.int64).reshape(-1, 4)
        a = a[np.lexsort((a[:, 1], a[:, 0]))]
        out = {}
        for g in np.unique(a[:, 0]).tolist():
            mine = a[a[:, 0] == g]
            terms, first, size = np.unique(mine[:, 1], return_index=True, return_counts=True)
            out[g] = terms, first, size, mine[:, 2], mine[:, 3].astype(bool)
        return out

    group_of = Vocabulary.group_of


def _inside(index: dict, group: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every entry of the rows' n-grams the row, the term inside, and whether the n-gram comes before it."""
    rows, subs, before = [], [], []
    for g, (terms, first, size, sub, early) in index.items():
        mine = np.flatnonzero(group == g)
        at = np.minimum(np.searchsorted(terms, term[mine]), len(terms) - 1)
        there = terms[at] == term[mine]
        mine, at = mine[there], at[there]
        n = size[at]
        entry = np.repeat(first[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        rows.append(np.repeat(mine, n))
        subs.append(sub[entry])
        before.append(early[entry])
    none = [np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)]
    return tuple(np.concatenate([x, *y]) for x, y in zip(none, (rows, subs, before)))


def take_off(batches: Iterable[pa.RecordBatch], keys: list[str], overlaps: Overlaps) -> Iterator[pa.RecordBatch]:
    """Rows ``(*keys, term_id, n, cnt)`` less the counts of the n-grams around them, of a partition that holds all rows of its documents."""
    table = [b for b in batches if len(b)]
    if not table:
        return
    table = pa.Table.from_batches(table).combine_chunks()
    column = lambda c: table.column(c).chunk(0)
    key, first = key_codes([column(c) for c in keys], len(table))
    of_key = overlaps.group_of([column(c).take(pa.array(first)) for c in overlaps.group], len(first))
    term, n, cnt = (column(c).to_numpy().astype(np.int64) for c in ("term_id", "n", "cnt"))

    def sums(key, term, n, *values):
        ids, code = np.unique(term, return_inverse=True)
        wide = int(n.max()) + 1
        mixed = (key * len(ids) + code) * wide + n
        order = np.argsort(mixed, kind="stable")
        mixed = mixed[order]
        starts = np.flatnonzero(np.append(True, mixed[1:] != mixed[:-1]))
        mixed = mixed[starts]
        return mixed // wide // len(ids), ids[mixed // wide % len(ids)], mixed % wide, *[np.add.reduceat(v[order], starts) for v in values]

    row, sub, early = _inside(overlaps.pairs, of_key[key], term)
    none = np.zeros(len(term), np.int64)
    key, term, n, c, off, soon = sums(
        np.append(key, key[row]), np.append(term, sub), np.append(n, np.full(len(row), 2)), np.append(cnt, np.zeros(len(row), np.int64)),
        np.append(none, cnt[row]), np.append(none, np.where(early, cnt[row], 0)))
    own = c > 0
    key, term, n, left, eff = key[own], term[own], n[own], (c - off)[own], (c - soon)[own]
    if not len(key):
        return
    row, sub, _ = _inside(overlaps.singles, of_key[key], term)
    key, term, n, c = sums(np.append(key, key[row]), np.append(term, sub), np.append(n, np.full(len(row), 1)), np.append(left, -eff[row]))
    own = c > 0
    at = pa.array(first[key[own]])
    yield from _output([*keys, "term_id", "n", "cnt"], [*[column(k).take(at) for k in keys], pa.array(term[own]), pa.array(n[own].astype(np.int32)), pa.array(c[own])])


def _lists(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.append(starts, len(values)).astype(np.int32)), pa.array(values.astype(np.int32)))


def _joined(terms: pa.Array, starts: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """The terms from each start to the next as one string, and the lengths of its terms in bytes."""
    terms = pa.concat_arrays([terms]).cast(pa.large_string())
    _, ends, data = terms.buffers()
    ends = np.frombuffer(ends, np.int64, len(terms) + 1)
    strings = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(ends[np.append(starts, len(terms))].copy()), data)
    return strings.cast(pa.string()), _lists(np.diff(ends), starts)


def _parted(strings: pa.Array, sizes: np.ndarray) -> pa.Array:
    """The terms of joined strings, one behind the other."""
    strings = pa.concat_arrays([strings]).cast(pa.large_string())
    _, ends, data = strings.buffers()
    start = np.frombuffer(ends, np.int64, 1)[0]
    return pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(start + np.append(0, np.cumsum(sizes))), data)


def combine(batches: Iterable[pa.RecordBatch], keys: list[str], distinct: bool, parts: int, n_max: int = 1, sep: str = " ") -> Iterator[pa.RecordBatch]:
    """Rows ``(part, *keys, terms, sizes, counts)`` from rows ``(*keys, grams)``; ``distinct`` counts a term once per row.

    With ``n_max`` the rows hold tokens, and their n-grams up to that length are formed here.
    """
    for batch in batches:
        grams = batch.column(len(keys))
        ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(grams), 0).to_numpy().astype(np.int64))])
        at = 0
        while at < len(batch):
            upto = max(at + 1, int(np.searchsorted(ends, ends[at] + PIECE_GRAMS // n_max, "right")) - 1)
            yield from _piece(batch.slice(at, upto - at), ends[at:upto + 1] - ends[at], keys, distinct, parts, n_max, sep)
            at = upto


def _formed(tokens: pa.Array, code: np.ndarray, doc: np.ndarray, n_max: int, sep: str) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Terms, and the term and row of each n-gram, from those of each token."""
    terms, codes, docs, gram = [tokens], [code], [doc], code
    total = len(tokens)
    for n in range(2, n_max + 1):
        there = doc[:-1][:max(0, len(code) - n + 1)] == doc[n - 1:]
        # Pieces of one row hold together, so an n-gram's first n-1 tokens are an (n-1)-gram: `gram` at the same place.
        mixed = (gram[:len(there)] * len(tokens) + code[n - 1:])[there]
        if not len(mixed):
            break
        _, first, found = np.unique(mixed, return_index=True, return_inverse=True)
        at = np.flatnonzero(there)
        words = [tokens.take(pa.array(code[at[first] + i])) for i in range(n)]
        terms.append(pc.binary_join_element_wise(*words, sep))
        codes.append(found + total)
        docs.append(doc[:len(there)][there])
        total += len(first)
        gram = np.zeros(len(there), np.int64)
        gram[at] = found
    all_terms, code = pa.concat_arrays(terms), np.concatenate(codes)
    if pc.any(pc.match_substring(tokens, sep)).as_py():  # a term may then come from several lengths
        e = all_terms.dictionary_encode()
        all_terms, code = e.dictionary, e.indices.to_numpy().astype(np.int64)[code]
    return all_terms, code, np.concatenate(docs)


def _piece(batch: pa.RecordBatch, ends: np.ndarray, keys: list[str], distinct: bool, parts: int, n_max: int, sep: str) -> Iterator[pa.RecordBatch]:
    n = len(batch)
    key, first = key_codes([batch.column(i) for i in range(len(keys))], n)
    e = batch.column(len(keys)).flatten().dictionary_encode()
    doc = np.repeat(np.arange(n), np.diff(ends))
    there = e.indices.is_valid().to_numpy(zero_copy_only=False)
    code, doc = e.indices.drop_null().to_numpy().astype(np.int64), doc[there]
    if not len(code):
        return
    words = e.dictionary
    if n_max > 1:
        words, code, doc = _formed(words, code, doc, n_max, sep)
    yield from _by_part(batch, key, first, keys, words, code, doc, distinct, parts)


def _by_part(batch: pa.RecordBatch, key: np.ndarray, first: np.ndarray, keys: list[str], words: pa.Array, code: np.ndarray, doc: np.ndarray,
             distinct: bool, parts: int) -> Iterator[pa.RecordBatch]:
    """Rows ``(part, *keys, terms, sizes, counts)`` of the terms ``code`` in the rows ``doc``, which have the keys numbered ``key``."""
    n = len(batch)
    if distinct:
        pair = np.sort(code * n + doc)
        pair = pair[np.append(True, pair[1:] != pair[:-1])]
        code, doc = pair // n, pair % n
    place = buckets(words, parts)
    rank = np.empty(len(words), np.int64)
    rank[np.argsort(place, kind="stable")] = np.arange(len(rank))
    # One sort for the order of rows (part, key) and the sums by term in it.
    k, width = len(first), len(rank)
    both = np.sort((place[code] * k + key[doc]) * width + rank[code])
    starts = np.flatnonzero(np.append(True, both[1:] != both[:-1]))
    counts = np.diff(np.append(starts, len(both)))
    both = both[starts]
    row = both // width
    back = np.empty(width, np.int64)
    back[rank] = np.arange(width)
    terms = words.take(pa.array(back[both % width]))
    heads = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    of = pa.array(first[row[heads] % k])
    yield pa.RecordBatch.from_arrays(
        [pa.array((row[heads] // k).astype(np.int32)), *[batch.column(i).take(of) for i in range(len(keys))],
         *_joined(terms, heads), _lists(counts, heads)], names=["part", *keys, "terms", "sizes", "counts"])


def _sums(batches: Iterable[pa.RecordBatch], keys: list[str]) -> tuple[pa.Table, np.ndarray, pa.Array, np.ndarray, np.ndarray, np.ndarray] | None:
    table = [b for b in batches if len(b)]
    if not table:
        return None
    table = pa.Table.from_batches(table).combine_chunks()
    column = lambda c: table.column(c).chunk(0)
    key, first = key_codes([column(c) for c in keys], len(table))
    size = pc.list_value_length(column("sizes")).to_numpy().astype(np.int64)
    e = _parted(column("terms"), column("sizes").flatten().to_numpy().astype(np.int64)).dictionary_encode()
    pair = e.indices.to_numpy().astype(np.int64) * len(first) + np.repeat(key, size)
    pair, n = _sum_by(pair, column("counts").flatten().to_numpy().astype(np.int64))
    return table.select(keys), first, e.dictionary.cast(pa.string()), pair // len(first), pair % len(first), n


def _sum_by(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and the sum of ``n`` of each."""
    order = np.argsort(key)
    key = key[order]
    starts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return key[starts], np.add.reduceat(n[order], starts)


def _output(names: list[str], arrays: list[pa.Array], rows: int = 200_000) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(arrays[0]), rows):
        yield pa.RecordBatch.from_arrays([a.slice(at, rows) for a in arrays], names=names)


def by_author(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows ``(*keys, term, cnt)`` of a partition that holds all rows of its terms."""
    found = _sums(batches, keys)
    if found is not None:
        table, first, terms, code, key, n = found
        at = pa.array(first[key])
        yield from _output([*keys, "term", "cnt"], [*[table.column(c).chunk(0).take(at) for c in keys], terms.take(pa.array(code)), pa.array(n)])


def by_term(batches: Iterable[pa.RecordBatch], group: list[str], author: str) -> Iterator[pa.RecordBatch]:
    """Rows ``(*group, term, df, n_authors)`` of a partition that holds all rows of its terms."""
    found = _sums(batches, [*group, author])
    if found is not None:
        table, first, terms, code, key, n = found
        columns = [table.column(c).chunk(0).take(pa.array(first)) for c in group]
        of, first = key_codes(columns, len(first))
        code = code * len(first) + of[key]
        both, df = _sum_by(code, n)
        _, authors = _sum_by(code, np.ones(len(code), np.int64))
        groups = [c.take(pa.array(first[both % len(first)])) for c in columns]
        yield from _output([*group, "term", "df", "n_authors"], [*groups, terms.take(pa.array(both // len(first))), pa.array(df), pa.array(authors)])
