"""Fill-in-the-middle by displacement scatter.

The texts of a batch lie in one buffer of bytes. Two cuts at line ends divide each text into prefix,
middle and suffix, and every piece moves as a whole: a difference array holds, at the first byte of
each piece, by how much its shift differs from that of the piece before. The running sum is the shift
of every byte, and one scatter puts all bytes of the batch in their place beside the markers. The
inverse finds the markers, builds the shifts of the way back alike, and gathers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tarmac.llm.common import SLICE_BYTES

#: Before prefix, suffix and middle.
MARKERS = ("<P>", "<S>", "<M>")
#: Bytes whose shifts are held at a time, so that a very long text needs little beside itself.
SHIFTS = 1 << 20
NEWLINE = 10

PLAIN, PSM, SPM = 0, 1, 2
FORMS = np.array(["plain", "psm", "spm"])

MADE = T.StructType([
    T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
    T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()),
    T.StructField("output", T.StringType())])


def _checked(markers) -> list[np.ndarray]:
    """The markers as bytes. None can begin inside one, so each is found once where it was put."""
    raw = [m.encode() for m in markers]
    heads = {m[:1] for m in raw}
    if len(raw) != 3 or len(set(raw)) != 3 or any(
            not m or any(m[i:i + 1] in heads for i in range(1, len(m))) for m in raw):
        raise ValueError(f"three different markers whose first byte stands nowhere else: {markers}")
    if any(a != b and a.startswith(b) for a in raw for b in raw):
        raise ValueError(f"no marker may begin with another: {markers}")
    return [np.frombuffer(m, np.uint8) for m in raw]


def _buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column, and the n + 1 places where its texts begin and end."""
    column = pc.fill_null(column, "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, places, data = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    ends = np.frombuffer(places, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[ends[0]:ends[-1]], ends - ends[0]


def _strings(data: np.ndarray, ends: np.ndarray, missing: np.ndarray | None = None) -> pa.Array:
    kind, places = (pa.string(), np.int32) if ends[-1] < 2**31 else (pa.large_string(), np.int64)
    mask = None if missing is None else pa.py_buffer(np.packbits(~missing, bitorder="little"))
    made = pa.Array.from_buffers(
        kind, len(ends) - 1, [mask, pa.py_buffer(ends.astype(places)), pa.py_buffer(data)])
    return made


def _move(source: np.ndarray, target: np.ndarray, begin: np.ndarray, shift: np.ndarray,
          gather: bool) -> None:
    """Scatter ``target[i + s] = source[i]``, or gather ``target[i] = source[i + s]``.

    Piece j begins at ``begin[j]``, ascending, and ``s`` is the ``shift`` of the piece that holds i.
    """
    step = np.diff(shift, prepend=0)
    size, upto = len(target) if gather else len(source), 0
    for low in range(0, size, SHIFTS):
        high = min(low + SHIFTS, size)
        first, last = np.searchsorted(begin, (low, high))
        difference = np.zeros(high - low, np.int64)
        np.add.at(difference, begin[first:last] - low, step[first:last])
        difference[0] += upto
        shifts = np.cumsum(difference)
        upto = shifts[-1]
        shifts += np.arange(low, high)
        if gather:
            target[low:high] = source[shifts]
        else:
            target[shifts] = source[low:high]


def _found(data: np.ndarray, ends: np.ndarray, marker: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where a marker stands and in which text; none reaches from one text into the next."""
    at = np.flatnonzero(data[:max(len(data) - len(marker) + 1, 0)] == marker[0])
    for i in range(1, len(marker)):
        at = at[data[at + i] == marker[i]]
    text = np.searchsorted(ends, at, "right") - 1
    inside = at + len(marker) <= ends[text + 1]
    return at[inside], text[inside]


def _points(data: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Code points of the ranges, which ascend and do not overlap: bytes that continue none."""
    counts = np.zeros(len(low), np.int64)
    some = np.flatnonzero(high > low)
    if len(some):
        edges = np.stack([low[some], high[some]], 1).ravel()
        if edges[-1] == len(data):
            edges = edges[:-1]
        counts[some] = np.add.reduceat((data & 0xC0) != 0x80, edges, dtype=np.int64)[::2]
    return counts


def cut_and_move(texts: pa.Array, draws: np.ndarray, rate: int, spm: int, markers) -> pa.StructArray:
    """The struct ``MADE`` of each text, from its four numbers (two cuts, whether, which form)."""
    prefix_mark, suffix_mark, middle_mark = marks = _checked(markers)
    data, ends = _buffer(texts)
    start, stop = ends[:-1], ends[1:]
    length = stop - start

    breaks = np.flatnonzero(data == NEWLINE)
    before, upto = np.searchsorted(breaks, start), np.searchsorted(breaks, stop)
    whole = upto - before
    open_end = np.zeros(len(start), bool)
    some = length > 0
    open_end[some] = data[stop[some] - 1] != NEWLINE
    n = whole + open_end

    def place(units):
        inner = (units > 0) & (units <= whole)
        at = np.where(units > 0, stop, start)
        at[inner] = breaks[before[inner] + units[inner] - 1] + 1
        return at

    picks = np.sort(draws[:, :2] % (n + 1)[:, None], axis=1)
    first, second = place(picks[:, 0]), place(picks[:, 1])
    form = np.where(draws[:, 3] % 100 < spm, SPM, PSM)
    form[(length == 0) | (draws[:, 2] % 100 >= rate)] = PLAIN
    for mark in marks:
        form[_found(data, ends, mark)[1]] = PLAIN

    plain = form == PLAIN
    grown = length + np.where(plain, 0, sum(map(len, marks)))
    out_ends = np.concatenate([[0], np.cumsum(grown)])
    prefix, suffix = first - start, stop - second
    base = out_ends[:-1]
    psm, spm_form = form == PSM, form == SPM
    to_prefix = np.where(psm, base + len(prefix_mark),
                         base + len(suffix_mark) + suffix + len(prefix_mark))
    to_suffix = np.where(psm, to_prefix + prefix + len(suffix_mark), base + len(suffix_mark))
    to_middle = np.where(spm_form, to_prefix + prefix, to_suffix + suffix) + len(middle_mark)
    to_prefix, to_middle, to_suffix = (
        np.where(plain, base + (piece - start), to)
        for piece, to in ((start, to_prefix), (first, to_middle), (second, to_suffix)))

    made = np.empty(out_ends[-1], np.uint8)
    begin = np.stack([start, first, second], 1)
    shift = np.stack([to_prefix, to_middle, to_suffix], 1) - begin
    _move(data, made, begin.ravel(), shift.ravel(), gather=False)
    for mark, to in zip(marks, (to_prefix, to_suffix, to_middle)):
        at = to[~plain] - len(mark)
        made[at[:, None] + np.arange(len(mark))] = mark

    columns = [
        pa.array(n, pa.int64()), pa.array(FORMS[form], pa.string()),
        pa.array(_points(data, start, first), pa.int64(), mask=plain),
        pa.array(_points(data, first, second), pa.int64(), mask=plain),
        _strings(made, out_ends).cast(pa.string()),
    ]
    return pa.StructArray.from_arrays(columns, MADE.names)


def move_back(outputs: pa.Array, forms: pa.Array, markers) -> pa.Array:
    """The texts that outputs and forms were made of; null where either is."""
    prefix_mark, suffix_mark, middle_mark = marks = _checked(markers)
    missing = np.asarray(pc.or_(pc.is_null(outputs), pc.is_null(forms)), bool)
    data, ends = _buffer(outputs)
    base, stop = ends[:-1], ends[1:]
    names = np.asarray(pc.fill_null(forms, "plain").to_pylist(), dtype=object)
    form = np.select([names == "psm", names == "spm"], [PSM, SPM], PLAIN)
    if not np.isin(names, FORMS).all():
        raise ValueError("a form that is not plain, psm or spm")
    form[missing] = PLAIN
    moved = np.flatnonzero(form != PLAIN)
    places = []
    for mark in marks:
        at, text = _found(data, ends, mark)
        ours = form[text] != PLAIN
        if not np.array_equal(text[ours], moved):
            raise ValueError("an output that does not hold each marker once")
        spot = base.copy()
        spot[moved] = at[ours]
        places.append(spot)
    at_prefix, at_suffix, at_middle = places
    psm, spm = form == PSM, form == SPM
    from_prefix = at_prefix + np.where(psm | spm, len(prefix_mark), 0)
    from_suffix = np.where(psm | spm, at_suffix + len(suffix_mark), stop)
    from_middle = np.where(psm | spm, at_middle + len(middle_mark), stop)
    prefix = np.where(psm, at_suffix, np.where(spm, at_middle, stop)) - from_prefix
    suffix = np.where(psm, at_middle, np.where(spm, at_prefix, stop)) - from_suffix
    middle = stop - from_middle
    if (prefix < 0).any() or (suffix < 0).any():
        raise ValueError("an output whose markers are in another order than its form's")
    back_ends = np.concatenate([[0], np.cumsum(prefix + middle + suffix)])
    to_prefix = back_ends[:-1]
    to_middle = to_prefix + prefix
    begin = np.stack([to_prefix, to_middle, to_middle + middle], 1)
    shift = np.stack([from_prefix, from_middle, from_suffix], 1) - begin
    back = np.empty(back_ends[-1], np.uint8)
    _move(data, back, begin.ravel(), shift.ravel(), gather=True)
    return _strings(back, back_ends, missing).cast(pa.string())


def _slices(batches):
    """Batches in slices of a bounded size; a longer text is a slice of its own."""
    for batch in batches:
        rows = max(1, int(batch.num_rows * SLICE_BYTES / max(batch.nbytes, 1)))
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _unused(name: str, df: DataFrame) -> str:
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _without(df: DataFrame, name: str) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() != name.lower()])


def draws_of(key: Column, seed: int) -> Column:
    """The first four groups of eight digits of the hash of seed and key, as numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return F.transform(F.array(*[F.lit(1 + 8 * i) for i in range(4)]),
                       lambda at: F.conv(F.substring(digest, at, F.lit(8)), 16, 10).cast("long"))


def fill_in_middle(docs: DataFrame, text: str = "text", key: str = "doc_id", seed: int = 7,
                   rate: int = 100, spm: int = 50, markers=MARKERS, into: str = "fim") -> DataFrame:
    """``docs`` with the struct ``into``: n, form, prefix_chars, middle_chars, output.

    A text has n lines, each with its line end. Of a hash of seed and key, the first two numbers cut
    it after so many lines, the third moves it in ``rate`` of 100 cases, and the fourth takes the
    form spm in ``spm`` of 100 cases, else psm. Null and empty texts and texts that hold a marker stay
    plain: the output is the text (empty for null), the lengths are null. A null key hashes like an empty one,
    repeated rows give the same output, an empty table gives no rows. A text of any length is moved
    whole. A given column of the name ``into`` is replaced; all others pass. No shuffle.
    """
    _checked(markers)
    given = _without(docs, into)
    numbers, names = _unused("draws", given), [*given.columns, into]
    at = [c.lower() for c in given.columns].index(text.lower())

    def run(batches):
        for batch in _slices(batches):
            draws = batch.column(batch.num_columns - 1).flatten().to_numpy().reshape(-1, 4)
            made = cut_and_move(batch.column(at), draws, rate, spm, markers)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], made], names=names)

    asked = given.withColumn(numbers, draws_of(F.col(key), seed))
    return asked.mapInArrow(run, T.StructType([*given.schema.fields, T.StructField(into, MADE)]))


def restore(done: DataFrame, made: str = "fim", name: str = "restored", markers=MARKERS) -> DataFrame:
    """``done`` with the text that the output and the form of the struct ``made`` give back.

    A null output or form gives null. An output that does not hold each marker of its form once, in
    that form's order, is an error. A given column called ``name`` is replaced. No shuffle.
    """
    _checked(markers)
    given = _without(done, name)
    at = [c.lower() for c in given.columns].index(made.lower())
    kinds = [f.name for f in given.schema[at].dataType]
    names, string = [*given.columns, name], to_arrow_type(T.StringType())

    def run(batches):
        for batch in _slices(batches):
            struct = batch.column(at)
            parts = [pc.struct_field(struct, kinds.index(part)) for part in ("output", "form")]
            back = move_back(*parts, markers).cast(string)
            yield pa.RecordBatch.from_arrays([*batch.columns, back], names=names)

    return given.mapInArrow(run, T.StructType([*given.schema.fields,
                                               T.StructField(name, T.StringType())]))


def report(docs: DataFrame) -> DataFrame:
    """One row per document: the shape of its transformation, and digests of output and way back."""
    moved = fill_in_middle(docs.select("doc_id", "text")).drop("text")
    return restore(moved).select(
        "doc_id", "fim.n", "fim.form", "fim.prefix_chars", "fim.middle_chars",
        F.sha2("fim.output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"))


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t,
             sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS lines,
        CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
        CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
c AS (SELECT *, len(lines) AS n, least(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS a,
        greatest(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS b,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
               OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
      FROM u),
p AS (SELECT *, array_to_string(lines[1:a], '') AS x, array_to_string(lines[a + 1:b], '') AS m,
        array_to_string(lines[b + 1:], '') AS s FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(x) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || x || '<S>' || s || '<M>' || m
         ELSE '<S>' || s || '<P>' || x || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p"""
