"""Removal of repeated byte strings by prefix-free parsing."""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.store import materialize
from tallyloom.llm.words import blocks, mix, prefix_sums, range_hash, text_bytes

LENGTH = 100  # bytes of a repeated string
PHRASES = 1 << 19  # that one group holds, on average
SALT_DOCS = 1 << 20  # documents whose phrases one group may hold
BYTES = 16 << 20  # of phrases or strings that one group of the comparison holds, on average
HOT = 1 << 14  # different phrases of one trigger beyond which they are dealt out by content
BUCKETS = 1 << 16  # of triggers, in which phrases to compare are counted
_LAST_ID = (1 << 63) - 1  # stands for a NULL id, which comes last
_REPLY, _AGAIN = 0, 1
_MARK = (1 << 32) - 1  # a start that no text has: says that a trigger has several phrases

PARSE = "kind int, part int, salt int, f binary, e binary, i binary, s binary, w binary, ids binary, ths binary"
FOUND = "id long, hash long, gone binary, at binary, wide binary, trigger binary"


def _least_places(hashes: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` hashes the place of the least one, the leftmost if several."""
    value, place, done = hashes, np.arange(len(hashes), dtype=np.int64), 1
    while done < width:
        step = min(done, width - done)
        later = value[step:] < value[:-step]
        value = np.where(later, value[step:], value[:-step])
        place = np.where(later, place[step:], place[:-step])
        done += step
    return place


def parse(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """The phrases of a block of texts: row, start, width, trigger's hash, phrase's hash.

    A trigger is the window of half of ``length`` bytes with the least rolling hash in
    a string of ``length``; so each string has one trigger, found in the string alone.
    A phrase is all successive strings with one trigger: ``width`` + 1 strings, and
    ``width + length`` bytes from ``start``. Phrases overlap by less than a string, and
    none is a prefix of what another one starts with: the trigger ends it.
    """
    half = length // 2
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    sums = prefix_sums(data)
    starts = np.arange(len(data) - half + 1)
    hashes = range_hash(sums, starts, starts + half)
    owner = _least_places(hashes, length - half + 1)
    counts = np.maximum(0, np.diff(offsets) - length + 1)
    row = np.repeat(np.arange(len(counts)), counts)
    first = np.cumsum(counts) - counts
    at = np.arange(counts.sum()) - np.repeat(first, counts) + offsets[row]
    owner = owner[at]
    new = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else none
    last = np.append(new[1:], len(owner)) - 1 if len(new) else none
    start, end, trigger = at[new], at[last] + length, owner[new]
    whole = range_hash(sums, start, end) + (trigger - start).astype(np.uint64)
    return row[new], start - offsets[row[new]], at[last] - start, hashes[trigger], mix(whole)


def _parsed(parts: int, salts: int, length: int, limit: int = 600_000):
    """All phrases, many texts at a time, dealt out by their trigger."""

    def flush(found: list[tuple[np.ndarray, ...]], ids: np.ndarray, salt: int) -> Iterator[pa.RecordBatch]:
        own, s, w, f, e = (np.concatenate(x) for x in zip(*found, strict=True))
        part = (f % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        own, s, w, f, e = (x[order] for x in (own, s, w, f, e))
        edges = np.searchsorted(part[order], np.arange(parts + 1))
        rows: list[tuple] = []
        for p in range(parts):
            a, b = int(edges[p]), int(edges[p + 1])
            if b > a:
                used, inverse = np.unique(own[a:b], return_inverse=True)
                blobs = (
                    f[a:b],
                    e[a:b],
                    inverse.astype(np.uint32),
                    s[a:b].astype(np.uint32),
                    w[a:b].astype(np.uint8),
                    ids[0, used],
                    ids[1, used],
                )
                rows.append((_REPLY, p, salt, *(x.tobytes() for x in blobs)))
            if len(rows) == 64:
                yield _batch(PARSE, rows)
                rows = []
        if rows:
            yield _batch(PARSE, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        salt = int(mix(np.array([TaskContext.get().partitionId() + 1], np.uint64))[0] % np.uint64(salts))
        found, ids, total, seen = [], [], 0, 0
        for batch in batches:
            keys = np.array([batch.column(c).to_pylist() for c in (0, 1)], np.int64)
            for row, data, offsets in blocks(batch.column(2)):
                own, s, w, f, e = parse(data, offsets, length)
                found.append((own + seen + row, s, w, f, e))
                total += len(own)
            ids.append(keys)
            seen += keys.shape[1]
            if total >= limit:
                yield from flush(found, np.concatenate(ids, axis=1), salt)
                found, ids, total, seen = [], [], 0, 0
        if total:
            yield from flush(found, np.concatenate(ids, axis=1), salt)

    return run


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def _types(schema: str) -> list[pa.DataType]:
    known = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return [known[part.split()[1]] for part in schema.split(", ")]


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * len(_names(schema))
    arrays = [pa.array(c, t) for c, t in zip(columns, _types(schema), strict=True)]
    return pa.RecordBatch.from_arrays(arrays, _names(schema))


def _table(schema: str, rows: list[tuple]) -> pa.Table:
    return pa.Table.from_batches([_batch(schema, rows)])


def _owner(doc: np.ndarray, owners: int) -> np.ndarray:
    return (mix(doc.view(np.uint64)) % np.uint64(owners)).astype(np.int64)


def _dealt(owner: np.ndarray, owners: int, kind: int, columns: dict[str, np.ndarray]) -> list[tuple]:
    """One row of :data:`PARSE` per owner with its values of the columns."""
    order = np.argsort(owner, kind="stable")
    edges = np.searchsorted(owner[order], np.arange(owners + 1))
    columns = {name: c[order] for name, c in columns.items()}
    return [
        (kind, o, 0, *(columns[c][edges[o] : edges[o + 1]].tobytes() if c in columns else b"" for c in _names(PARSE)[3:]))
        for o in range(owners)
        if edges[o + 1] > edges[o]
    ]


def _forward(parts: int, hot: int, columns: dict[str, np.ndarray]) -> list[tuple]:
    """First places of phrases, by trigger and content, for the step that sees all documents.

    They are dealt out by trigger. The phrases of one that has more than ``hot`` here go,
    by content, to the second ``parts`` groups, and two marks go in their place.
    """
    f, e = columns["f"], columns["e"]
    used, inverse, n = np.unique(f, return_inverse=True, return_counts=True)
    many, part = (n > hot)[inverse], (f % np.uint64(parts)).astype(np.int64)
    part[many] = parts + (mix(f[many] ^ e[many]) % np.uint64(parts)).astype(np.int64)
    marked = np.repeat(used[n > hot], 2)
    marks = {c: np.zeros(len(marked), x.dtype) for c, x in columns.items()}
    marks |= {"f": marked, "s": np.full(len(marked), _MARK, np.uint32)}
    marks["e"][1::2] = ~np.uint64(0)
    part = np.concatenate([part, (marked % np.uint64(parts)).astype(np.int64)])
    columns = {c: np.concatenate([x, marks[c]]) for c, x in columns.items()}
    rows = _dealt(part, 2 * parts, _AGAIN, columns)
    # Each place has an entry of its own in the list of documents.
    return [(*r[:5], np.arange(len(r[6]) // 4, dtype=np.uint32).tobytes(), *r[6:]) for r in rows]


def _compare_phrases(parts: int, owners: int, last: bool, hot: int = HOT) -> Callable[[pa.Table], pa.Table]:
    """The dictionary of a part: phrases by trigger and content, each with its first place.

    Every other place of a phrase is a repetition as a whole. The first places of the
    phrases of a trigger that has several are to be compared string by string. Before
    the last step the first places go on to the step that sees all documents. There a
    phrase of a hot trigger may have a first place in two groups; its strings are then
    compared from both.
    """

    def run(table: pa.Table) -> pa.Table:
        by_content = last and table.column("part")[0].as_py() >= parts
        found = []
        for f, e, i, s, w, ids, ths in zip(*(table.column(c).to_pylist() for c in _names(PARSE)[3:]), strict=True):
            own = np.frombuffer(i, np.uint32)
            found.append(
                (
                    np.frombuffer(f, np.uint64),
                    np.frombuffer(e, np.uint64),
                    np.frombuffer(ids, np.int64)[own],
                    np.frombuffer(ths, np.int64)[own],
                    np.frombuffer(s, np.uint32),
                    np.frombuffer(w, np.uint8),
                )
            )
        f, e, doc, th, s, w = (np.concatenate(x) for x in zip(*found, strict=True))
        del found
        order = np.lexsort((s, th, doc, e, f))
        f, e, doc, th, s, w = (x[order] for x in (f, e, doc, th, s, w))
        new_f = np.ones(len(f), bool)
        new_f[1:] = f[1:] != f[:-1]
        new_e = new_f.copy()
        new_e[1:] |= e[1:] != e[:-1]
        place = new_e.copy()
        place[1:] |= (doc[1:] != doc[:-1]) | (th[1:] != th[:-1]) | (s[1:] != s[:-1])
        mark = s == _MARK
        gone = place & ~new_e & ~mark
        trigger = np.cumsum(new_f) - 1
        several = ((np.bincount(trigger, new_e)[trigger] > 1) | by_content) & ~mark
        rows: list[tuple] = []
        if last:
            shown = gone | (new_e & several)
            kind = np.where(gone, 0, 1).astype(np.uint8)
            columns = {"f": f, "e": kind, "s": s, "w": w, "ids": doc, "ths": th}
            columns = {name: c[shown] for name, c in columns.items()}
            rows = _dealt(_owner(doc[shown], owners), owners, _REPLY, columns)
        else:
            columns = {"f": f, "e": np.zeros(len(f), np.uint8), "s": s, "w": w, "ids": doc, "ths": th}
            columns = {name: c[gone] for name, c in columns.items()}
            rows = _dealt(_owner(doc[gone], owners), owners, _REPLY, columns)
            columns = {"f": f, "e": e, "s": s, "w": w, "ids": doc, "ths": th}
            columns = {name: c[new_e] for name, c in columns.items()}
            rows += _forward(parts, hot, columns)
        return _table(PARSE, rows)

    return run


def _by_document(table: pa.Table) -> pa.Table:
    """What was found for each document: strings that go, and phrases to compare."""
    kinds = {"f": np.uint64, "e": np.uint8, "s": np.uint32, "w": np.uint8, "ids": np.int64, "ths": np.int64}
    f, kind, s, w, doc, th = (
        np.concatenate([np.frombuffer(x, t) for x in table.column(c).to_pylist()]) for c, t in kinds.items()
    )
    order = np.lexsort((s, kind, th, doc))
    f, kind, s, w, doc, th = (x[order] for x in (f, kind, s, w, doc, th))
    new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (th[1:] != th[:-1])]))
    rows = []
    for a, b in zip(new.tolist(), [*new[1:].tolist(), len(doc)], strict=True):
        middle = a + int(np.searchsorted(kind[a:b], 1))
        gone = np.stack([s[a:middle], s[a:middle] + w[a:middle]], 1).astype("<u4")
        rest = slice(middle, b)
        rows.append((doc[a], th[a], gone.tobytes(), s[rest].tobytes(), w[rest].tobytes(), f[rest].tobytes()))
    return _table(FOUND, rows)


PHRASE_BYTES = "part int, s binary, w binary, ids binary, ths binary, bytes binary"


def _bucket(f: np.ndarray) -> np.ndarray:
    return (mix(f) % np.uint64(BUCKETS)).astype(np.int64)


def _count_borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The phrases to compare and their strings, by bucket of triggers."""
    phrases, strings = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        f = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint64)
        w = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8)
        bucket = _bucket(f)
        np.add.at(phrases, bucket, 1)
        np.add.at(strings, bucket, w.astype(np.int64) + 1)
    used = np.flatnonzero(phrases)
    columns = [pa.array(used), pa.array(phrases[used]), pa.array(strings[used])]
    yield pa.RecordBatch.from_arrays(columns, ["bucket", "phrases", "strings"])


def _string_hashes(strings: np.ndarray) -> np.ndarray:
    """One hash for each row of bytes."""
    n, length = strings.shape
    out, step = np.zeros(n, np.uint64), max(1, (1 << 19) // length)
    for low in range(0, n, step):
        some = strings[low : low + step]
        at = np.arange(len(some)) * length
        out[low : low + step] = range_hash(prefix_sums(some.ravel()), at, at + length)
    return out


def _cut_phrases(parts: int, length: int, hot: frozenset[int] = frozenset(), hot_parts: int = 1, limit: int = 16 << 20):
    """The bytes of the phrases to compare, dealt out by their trigger.

    Phrases of triggers in ``hot`` buckets are cut into their strings, which are dealt
    out by their bytes to ``hot_parts`` groups beyond ``parts``. Of equal strings met
    together only the first goes there; the places of the others, which are
    repetitions, go without bytes to groups beyond these.
    """
    is_hot = np.zeros(BUCKETS, bool)
    is_hot[list(hot)] = True

    def flush(found: list[tuple]) -> pa.RecordBatch:
        rows = []
        by_part: dict[int, list[tuple]] = {}
        for part, *rest in found:
            by_part.setdefault(part, []).append(tuple(rest))
        for part, own in by_part.items():
            s, w, doc, th, raw = zip(*own, strict=True)
            blobs = (np.array(s, np.uint32), np.array(w, np.uint8), np.array(doc, np.int64), np.array(th, np.int64))
            rows.append((part, *(x.tobytes() for x in blobs), b"".join(raw)))
        return _batch(PHRASE_BYTES, rows)

    def flush_strings(found: list[tuple]) -> pa.RecordBatch:
        s, doc, th, strings = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((s, th, doc))
        # A document that stands in several rows has each place once.
        new = np.ones(len(order), bool)
        new[1:] = np.any([np.diff(x[order]) != 0 for x in (s, doc, th)], axis=0)
        order = order[new]
        keys = strings.view(f"S{length}").ravel()
        order = order[np.argsort(keys[order], kind="stable")]
        first = np.ones(len(order), bool)
        first[1:] = keys[order[1:]] != keys[order[:-1]]
        shown, known = order[first], order[~first]
        rows: list[tuple] = []
        dealt = (
            (shown, parts, _string_hashes(strings[shown])),
            (known, parts + hot_parts, mix(doc[known].view(np.uint64))),
        )
        for own, low, hashes in dealt:
            part = (hashes % np.uint64(hot_parts)).astype(np.int64)
            by_part = np.argsort(part, kind="stable")
            own, part = own[by_part], part[by_part]
            edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(own)] if len(own) else []
            for a, b in itertools.pairwise(edges):
                some = own[a:b]
                blobs = (s[some].astype(np.uint32), np.zeros(b - a, np.uint8), doc[some], th[some])
                raw = strings[some].tobytes() if low == parts else b""
                rows.append((low + int(part[a]), *(x.tobytes() for x in blobs), raw))
        return _batch(PHRASE_BYTES, rows)

    def cut_strings(data: np.ndarray, low: int, start: np.ndarray, width: np.ndarray, doc: int, th: int):
        """The strings of phrases of one document, some thousand phrases at a time."""
        step = max(1, limit // (length * length))
        windows = np.lib.stride_tricks.sliding_window_view(data, length)
        for k in range(0, len(start), step):
            counts = width[k : k + step].astype(np.int64) + 1
            inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            s = np.repeat(start[k : k + step].astype(np.int64), counts) + inner
            keys = np.full(len(s), doc, np.int64), np.full(len(s), th, np.int64)
            yield s, *keys, np.ascontiguousarray(windows[low + s])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, total = [], 0
        single, n_single = [], 0
        for batch in batches:
            data, offsets = text_bytes(batch.column(2))
            keys = zip(*(batch.column(c).to_pylist() for c in (0, 1, 3, 4, 5)), strict=True)
            for r, (doc, th, at, wide, trigger) in enumerate(keys):
                f = np.frombuffer(trigger, np.uint64)
                s, w = np.frombuffer(at, np.uint32), np.frombuffer(wide, np.uint8)
                if hot and (many := is_hot[_bucket(f)]).any():
                    for strings in cut_strings(data, int(offsets[r]), s[many], w[many], doc, th):
                        single.append(strings)
                        n_single += len(strings[0])
                        if n_single * length >= limit:
                            yield flush_strings(single)
                            single, n_single = [], 0
                    f, s, w = f[~many], s[~many], w[~many]
                f = f % np.uint64(parts)
                for part, start, width in zip(f.tolist(), s.tolist(), w.tolist(), strict=True):
                    low = int(offsets[r]) + start
                    found.append((part, start, width, doc, th, data[low : low + width + length].tobytes()))
                    total += width + length
                if total >= limit:
                    yield flush(found)
                    found, total = [], 0
        if found:
            yield flush(found)
        if single:
            yield flush_strings(single)

    return run


def _compare_strings(owners: int, length: int, limit: int = 1 << 17) -> Callable[[pa.Table], pa.Table]:
    """The suffix array of a part's phrases, cut to ``length`` bytes, and who stands first.

    The phrases' suffixes of ``length`` bytes or more are put in corpus order, then
    sorted by their first eight bytes and, in runs, by all of them; the sorts are
    stable, so of equal strings the first one of the corpus comes first. Places without
    bytes are known repetitions and only handed on.
    """

    def run(table: pa.Table) -> pa.Table:
        kinds = {"s": np.uint32, "w": np.uint8, "ids": np.int64, "ths": np.int64, "bytes": np.uint8}
        s, w, doc, th, data = (
            np.concatenate([np.frombuffer(x, t) for x in table.column(c).to_pylist()]) for c, t in kinds.items()
        )
        if not len(data):
            columns = {"f": np.zeros(len(s), np.uint64), "e": w, "s": s, "w": w, "ids": doc, "ths": th}
            return _table(PARSE, _dealt(_owner(doc, owners), owners, _REPLY, columns))
        size = w.astype(np.int64) + length
        begin = np.cumsum(size) - size
        order = np.lexsort((s, th, doc))
        # A document that stands in several rows, or was met in two groups, counts once.
        new = np.ones(len(order), bool)
        new[1:] = np.any([np.diff(x[order]) != 0 for x in (s, doc, th)], axis=0)
        order = order[new]
        counts = w[order].astype(np.int64) + 1
        own = np.repeat(order, counts)
        inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        at = begin[own] + inner
        strings = np.lib.stride_tricks.sliding_window_view(data, length)
        head = np.zeros(len(at), np.uint64)
        for k in range(8):
            head = head << np.uint64(8) | data[at + k]
        order = np.argsort(head, kind="stable")
        sorted_head = head[order]
        runs = np.flatnonzero(np.concatenate([[True], sorted_head[1:] != sorted_head[:-1]]))
        runs = np.append(runs, len(order))
        gone = np.zeros(len(at), bool)
        low = 0
        while low < len(runs) - 1:
            high = max(low + 1, int(np.searchsorted(runs, runs[low] + limit, "right")) - 1)
            chosen = order[runs[low] : runs[high]]
            low = high
            if len(chosen) < 2:
                continue
            some = np.ascontiguousarray(strings[at[chosen]]).view(f"S{length}").ravel()
            suffixes = np.argsort(some, kind="stable")
            same = some[suffixes[1:]] == some[suffixes[:-1]]
            gone[chosen[suffixes[1:][same]]] = True
        own, start = own[gone], (s[own].astype(np.int64) + inner)[gone]
        columns = {
            "f": np.zeros(len(own), np.uint64),
            "e": np.zeros(len(own), np.uint8),
            "s": start.astype(np.uint32),
            "w": np.zeros(len(own), np.uint8),
            "ids": doc[own],
            "ths": th[own],
        }
        return _table(PARSE, _dealt(_owner(doc[own], owners), owners, _REPLY, columns))

    return run


SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary, spans string"


def _results(length: int, texts: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = _names(SCHEMA)
    chosen = [n for n in names if texts or n not in ("kept", "spans")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            whole, view = data.tobytes(), memoryview(data)
            rows: list[tuple] = []
            gone = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
            for r, lists in enumerate(gone):
                low, high = int(offsets[r]), int(offsets[r + 1])
                strings = [np.frombuffer(x, "<u4").reshape(-1, 2) for x in lists if x]
                digest, at, spans, parts = hashlib.sha256(), low, [], []
                if strings:
                    pairs = np.concatenate(strings).astype(np.int64)
                    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
                    reach = np.maximum.accumulate(pairs[:, 1] + length)
                    new = np.flatnonzero(np.concatenate([[True], pairs[1:, 0] > reach[:-1]]))
                    ends = reach[np.append(new[1:], len(pairs)) - 1]
                    spans = list(zip(pairs[new, 0].tolist(), ends.tolist(), strict=True))
                for start, end in spans:
                    digest.update(view[at : low + start])
                    parts.append(whole[at : low + start] if texts else b"")
                    at = low + end
                digest.update(view[at:high])
                parts.append(whole[at:high] if texts else b"")
                removed = sum(b - a for a, b in spans)
                row = (high - low, removed, len(spans), digest.hexdigest())
                if texts:
                    row += (b"".join(parts), ",".join(f"{a}:{b}" for a, b in spans))
                rows.append(row)
            columns = list(zip(*rows, strict=True)) or [[]] * (len(chosen) - 1)
            types = [pa.int64()] * 3 + [pa.string(), pa.binary(), pa.string()]
            arrays = [batch.column(0)]
            arrays += [pa.array(c, t) for c, t in zip(columns, types, strict=False)]
            yield pa.RecordBatch.from_arrays(arrays, chosen)

    return run


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    texts: bool = False,
    salt_docs: int = SALT_DOCS,
    phrases: int = PHRASES,
    hot: int = HOT,
) -> DataFrame:
    """One row per document without the bytes of strings that start earlier in the corpus.

    Each byte goes that a string of ``length`` bytes covers which also starts in a
    document of a smaller id, or further up in the same one. All strings of the input
    count, also those that go themselves. ``texts`` adds the kept bytes and the removed
    spans (byte offsets, end exclusive) to the counts and the hash.

    Texts are parsed at triggers of a rolling hash into phrases (see :func:`parse`); equal
    strings have equal triggers. The parse, some bytes a phrase, is dealt out by trigger
    and gives the dictionary: of a phrase that occurs again all places but the first
    repeat it whole. Only phrases with one trigger but different content, at the borders
    of repeated passages, are fetched as bytes, and the suffix array of these decides
    string by string. Strings longer than ``length`` need no suffix order of the parse:
    a phrase holds all of each of its strings. Phrases are equal by two 64-bit hashes,
    border strings by their bytes.

    Groups are by trigger and, beyond ``salt_docs`` documents, by shares of the
    documents first, each of which passes one place per phrase on. That reduces the
    inner phrases of a passage of very many documents, but not those at its borders,
    which share a trigger and differ in each document. Of a trigger with more than
    ``hot`` phrases the shares pass them on by content, and the strings of its phrases
    are compared in groups by their own bytes, after each task has left one place per
    string; so neither is gathered in one task. What is found comes back to the texts by
    id, in two joins over one shuffle of the texts.

    NULL is an empty text. A NULL id comes after all others; rows that agree in id and
    text are one document, with one result for each row; rows of one id with other
    texts are ordered by a hash of the text. An empty table gives none; other columns
    are not read.
    """
    given = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST_ID)).alias("id"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("hash"),
        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"),
    )
    n_docs, n_bytes = docs.agg(F.count("*"), F.sum(F.octet_length(text_col))).first()
    salts = -(-n_docs // salt_docs) or 1
    parts = -(-(n_bytes or 0) * 4 // (length * phrases * salts)) or 1
    owners = parts * salts

    parsed = given.where(F.octet_length("text") >= length).select("id", "hash", "text")
    parsed = parsed.mapInArrow(_parsed(parts, salts, length), PARSE)
    found = parsed.groupBy("part", "salt").applyInArrow(_compare_phrases(parts, owners, salts == 1, hot), PARSE)
    if salts > 1:
        found = materialize(found, "parse")
        again = found.where(F.col("kind") == _AGAIN).groupBy("part")
        found = found.where(F.col("kind") == _REPLY).unionByName(
            again.applyInArrow(_compare_phrases(parts, owners, True), PARSE)
        )
    found = materialize(found.groupBy("part").applyInArrow(_by_document, FOUND), "found")

    borders = found.where(F.length("at") > 0).select("id", "hash", "at", "wide", "trigger")
    n_phrases = borders.agg(F.sum(F.length("wide"))).first()[0] or 0
    groups = -(-n_phrases * (length + length // 4) // BYTES) or 1
    counted = borders.select("trigger", "wide").mapInArrow(_count_borders, "bucket long, phrases long, strings long")
    counted = counted.groupBy("bucket").agg(F.sum("phrases").alias("phrases"), F.sum("strings").alias("strings"))
    above = counted.where(F.col("phrases") > max(hot, 4 * n_phrases // BUCKETS)).collect()
    buckets = frozenset(r["bucket"] for r in above)
    hot_parts = -(-sum(r["strings"] for r in above) * length // BYTES) or 1
    # All columns of the texts go along, so that both joins share one shuffle of them.
    fetched = given.join(borders, ["id", "hash"]).select(
        "id", "hash", "text", "at", "wide", "trigger", "doc_id"
    )
    compared = fetched.mapInArrow(_cut_phrases(groups, length, buckets, hot_parts), PHRASE_BYTES).groupBy("part")
    compared = compared.applyInArrow(_compare_strings(owners, length), PARSE)
    compared = compared.groupBy("part").applyInArrow(_by_document, FOUND)
    gone = found.select("id", "hash", F.col("gone").alias("whole")).join(
        compared.select("id", "hash", F.col("gone").alias("border")), ["id", "hash"], "full"
    )
    gone = gone.where("length(whole) > 0 or length(border) > 0")
    joined = given.join(gone, ["id", "hash"], "left")
    chosen = SCHEMA if texts else SCHEMA.replace(", kept binary, spans string", "")
    return joined.select("doc_id", "text", "whole", "border").mapInArrow(_results(length, texts), chosen)
