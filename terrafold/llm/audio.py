"""Recordings that sound alike: chroma fingerprints, offset histograms and bit errors."""

from __future__ import annotations

import io
import wave
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrafold.llm.shared import Scratch

PITCHES = 12
#: (kind, first pitch class, pitch classes, frames) of the 16 filters: five ways to split a
#: rectangle, at growing sizes.
FILTERS = [(1 + i % 5, (i * 5) % (PITCHES - h + 1), h, w) for i in range(16) for h, w in [((4, 6, 8, 12)[i // 4], (4, 6, 6, 8)[(i * 3) // 4 % 4])]]
WIDEST = max(f[3] for f in FILTERS)
#: Frames between the three fingerprints of a landmark.
STEP = 4
#: Bits of a landmark that a query also tries the other way: those nearest to their thresholds.
PROBED = 5
#: Places, from a landmark's, of the fingerprints beside it; a meeting counts if at most this share of
#: their bits differ.
BESIDE, MOST_BESIDE = (-8, -4, 12, 16), 0.3
#: Bit errors up to which an alignment is a match, and frames that must overlap.
MOST_ERRORS, LEAST_OVERLAP = 0.15, 16
#: Responses are multiples of 1 / 2 ** GRAIN, so that all of them can be counted by value.
GRAIN = 10
#: Responses of recordings that are counted together, about.
_COUNTED = 1 << 20


def decode_wav(data: bytes) -> tuple[np.ndarray, int]:
    """Samples (mono, -1 to 1) and rate of 8 or 16 bit PCM in a WAV container."""
    with wave.open(io.BytesIO(data)) as f:
        raw, width, channels, rate = f.readframes(f.getnframes()), f.getsampwidth(), f.getnchannels(), f.getframerate()
    if width == 2:
        x = np.frombuffer(raw, "<i2") / 32768
    else:
        x = np.frombuffer(raw, np.uint8) / 128 - 1
    return x[: len(x) // channels * channels].reshape(-1, channels).mean(axis=1), rate


def chroma(samples: np.ndarray, rate: int, frame: int = 256, hop: int = 128, lowest: float = 200.0, highest: float = 3600.0) -> np.ndarray:
    """Frames by pitch class: log energy of the spectrum between two frequencies, folded into an octave."""
    if len(samples) < frame:
        return np.zeros((0, PITCHES))
    shown = np.lib.stride_tricks.sliding_window_view(samples, frame)[::hop]
    power = np.abs(np.fft.rfft(shown * np.hanning(frame), axis=1)) ** 2
    freq = np.fft.rfftfreq(frame, 1 / rate)
    use = np.flatnonzero((freq >= lowest) & (freq <= min(highest, rate / 2)))
    pitch = np.round(PITCHES * np.log2(freq[use] / 440)).astype(int) % PITCHES
    fold = np.zeros((len(use), PITCHES))
    fold[np.arange(len(use)), pitch] = 1
    return np.log(power[:, use] @ fold + 1e-6)


def responses(frames: np.ndarray) -> np.ndarray:
    """What each filter gives at each frame, from the integral image."""
    n = len(frames) - WIDEST + 1
    if n <= 0:
        return np.zeros((0, len(FILTERS)))
    total = np.zeros((len(frames) + 1, PITCHES + 1))
    total[1:, 1:] = frames.cumsum(axis=0).cumsum(axis=1)
    t = np.arange(n)

    def area(t0: int, t1: int, y0: int, y1: int) -> np.ndarray:
        """Mean over frames t + t0 to t + t1 and pitch classes y0 to y1."""
        s = total[t + t1, y1] - total[t + t0, y1] - total[t + t1, y0] + total[t + t0, y0]
        return s / ((t1 - t0) * (y1 - y0))

    out = np.zeros((n, len(FILTERS)))
    for k, (kind, y, h, w) in enumerate(FILTERS):
        if kind == 1:  # lower against upper pitches
            r = area(0, w, y, y + h // 2) - area(0, w, y + h // 2, y + h)
        elif kind == 2:  # before against after
            r = area(0, w // 2, y, y + h) - area(w // 2, w, y, y + h)
        elif kind == 3:  # both, crossed
            r = area(0, w // 2, y, y + h // 2) - area(w // 2, w, y, y + h // 2) - area(0, w // 2, y + h // 2, y + h) + area(w // 2, w, y + h // 2, y + h)
        elif kind == 4:  # middle pitches against the others
            r = 2 * area(0, w, y + h // 4, y + h - h // 4) - area(0, w, y, y + h // 4) - area(0, w, y + h - h // 4, y + h)
        else:  # middle frames against the others
            r = 2 * area(w // 4, w - w // 4, y, y + h) - area(0, w // 4, y, y + h) - area(w - w // 4, w, y, y + h)
        out[:, k] = r
    return np.ldexp(np.rint(np.ldexp(out, GRAIN)), -GRAIN)


def quantise(response: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """32-bit fingerprints: the quarter of each of 16 responses in two bits of Gray code."""
    level = (response[:, :, None] > thresholds[None]).sum(axis=2).astype(np.uint32)
    gray = level ^ (level >> 1)
    return (gray << (2 * np.arange(len(FILTERS), dtype=np.uint32))).sum(axis=1, dtype=np.uint32)


def _halves(prints: np.ndarray) -> np.ndarray:
    """For each of the 16 filters, whether it is above its median."""
    out = np.zeros(len(prints), np.uint64)
    for i in range(len(FILTERS)):
        out |= ((prints >> np.uint32(2 * i + 1)) & np.uint32(1)).astype(np.uint64) << np.uint64(i)
    return out


def landmarks(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys (the halves of three fingerprints) and places of a recording's landmarks, and the halves of
    the fingerprints beside each with a mask of those that there are. Every place is a landmark but
    where the key is that of the place before."""
    n = len(prints) - 2 * STEP
    if n <= 0:
        return (np.empty(0, np.int64),) * 4
    half = _halves(prints)
    key = (half[: -2 * STEP] << np.uint64(32)) | (half[STEP:-STEP] << np.uint64(16)) | half[2 * STEP :]
    place = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    beside, mask = np.zeros(len(place), np.uint64), np.zeros(len(place), np.uint64)
    for k, step in enumerate(BESIDE):
        at = place + step
        there = (at >= 0) & (at < len(half))
        beside[there] |= half[at[there]] << np.uint64(16 * k)
        mask[there] |= np.uint64(0xFFFF) << np.uint64(16 * k)
    return key[place].view(np.int64), place.astype(np.int64), beside.view(np.int64), mask.view(np.int64)


def probes(keys: np.ndarray, places: np.ndarray, response: np.ndarray, thresholds: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """Each key with every change of its ``PROBED`` least certain bits, 2 ** PROBED for a key."""
    near = np.abs(response - thresholds[:, 1]) / spread
    margin = np.concatenate([near[places + 2 * STEP], near[places + STEP], near[places]], axis=1)
    bits = np.argsort(margin, axis=1)[:, :PROBED].astype(np.int64)
    out = np.repeat(keys[:, None], 1 << PROBED, axis=1)
    for k in range(PROBED):
        out[:, (np.arange(1 << PROBED) >> k & 1).astype(bool)] ^= (np.int64(1) << bits[:, k])[:, None]
    return out.ravel()


Decode = Callable[[object], tuple[np.ndarray, int]]


def _counted(recordings: DataFrame, decode: Decode) -> DataFrame:
    """(filter, step, n): how often a filter gives a response, in steps of 1 / 2 ** ``GRAIN``, in all
    frames of all ``recordings`` (media)."""

    def summed(parts: list[np.ndarray]) -> pa.RecordBatch:
        key, n = np.unique(np.concatenate(parts), return_counts=True)
        return pa.record_batch([pa.array(key), pa.array(n.astype(np.int64))], names=["key", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[np.ndarray] = []
        held = 0
        for batch in batches:
            for value in batch.column(0):
                r = responses(chroma(*decode(value.as_py())))
                steps = np.ldexp(r[np.isfinite(r).all(axis=1)], GRAIN).astype(np.int64)
                parts.append((steps * len(FILTERS) + np.arange(len(FILTERS))).ravel())
                held += len(parts[-1])
                if held > _COUNTED:
                    yield summed(parts)
                    parts, held = [], 0
        if parts:
            yield summed(parts)

    all_ = recordings.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    of = F.pmod("key", F.lit(len(FILTERS)))
    return all_.select(of.cast("int").alias("filter"), F.expr(f"(key - pmod(key, {len(FILTERS)})) div {len(FILTERS)}").alias("step"), "n")


def _columns(counts: DataFrame) -> list[np.ndarray]:
    """The columns (filter, value, n) of a small table in order of filter and value."""
    table = counts.toArrow()
    found = [x.to_numpy() for x in table.columns]
    order = np.lexsort((found[1], found[0]))
    return [x[order] for x in found]


def fit_thresholds(recordings: DataFrame, media: str, decode: Decode = decode_wav) -> np.ndarray:
    """Quartiles of each filter's responses in all frames of all recordings: the least response that a
    quarter, half or three quarters of them don't exceed. Recordings stay where they are; copies count.

    The responses are counted by value; the driver gets counts of whole units, then those of the
    steps of the units that the quartiles lie in, however many recordings there are.
    """
    out = np.zeros((len(FILTERS), 3))
    rows = recordings.select(F.col(media).alias("media")).where("media is not null")
    scratch = Scratch(recordings.sparkSession, "thresholds")
    counts = scratch.write(_counted(rows, decode))
    unit = F.shiftright("step", GRAIN).alias("unit")
    kind, units, n = _columns(counts.groupBy("filter", unit).agg(F.sum("n").alias("n")).select("filter", "unit", "n"))
    places = []
    for k in np.unique(kind):
        own, upto = units[kind == k], n[kind == k].cumsum()
        for q in range(3):
            at = np.searchsorted(4 * upto, (q + 1) * upto[-1])
            places.append((int(k), q, int(own[at]), int(upto[at] - n[kind == k][at]), int(upto[-1])))
    code = F.shiftright("step", GRAIN) * len(FILTERS) + F.col("filter")
    kind, steps, n = _columns(counts.where(code.isin([u * len(FILTERS) + k for k, _, u, _, _ in places])))
    for k, q, u, before, total in places:
        inside = (kind == k) & (steps >> GRAIN == u)
        at = np.searchsorted(4 * (before + n[inside].cumsum()), (q + 1) * total)
        out[k, q] = steps[inside][at] / (1 << GRAIN)
    scratch.drop(counts)
    return out


_MADE = ("prints array<int>", "keys array<long>", "places array<long>", "beside array<long>", "masks array<long>", "probes array<long>")


def fingerprints(recordings: DataFrame, thresholds: np.ndarray, media: str, decode: Decode = decode_wav) -> DataFrame:
    """(id, is_query, prints, keys, places, beside, masks, probes): fingerprints and landmarks of each
    recording, and the probes of queries. Null media and recordings too short for a fingerprint
    have none."""
    spread = np.maximum(thresholds[:, 2] - thresholds[:, 0], 1e-9)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in _MADE]
            for asked, value in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                r = responses(chroma(*decode(value.as_py()))) if value.is_valid else np.zeros((0, len(FILTERS)))
                p = quantise(r, thresholds)
                own = landmarks(p)
                tried = probes(*own[:2], r, thresholds, spread) if asked and len(own[0]) else np.empty(0, np.int64)
                for column, x in zip(out, (p.view(np.int32), *own, tried), strict=True):
                    column.append(x)
            kinds = [pa.list_(pa.int32()), *[pa.list_(pa.int64())] * 5]
            yield pa.record_batch([batch.column(0), batch.column(1), *[pa.array(x, t) for x, t in zip(out, kinds, strict=True)]], names=["id", "is_query", *[x.split()[0] for x in _MADE]])

    return recordings.select("id", "is_query", F.col(media)).mapInArrow(run, "id long, is_query boolean, " + ", ".join(_MADE))


def bit_errors(a: np.ndarray, b: np.ndarray, offset: int) -> tuple[float, int]:
    """Share of differing bits of two fingerprint rows where place i of ``a`` is i + offset of
    ``b``, and how many fingerprints overlap."""
    start, end = max(0, -offset), min(len(a), len(b) - offset)
    if end <= start:
        return 1.0, 0
    x = a[start:end].view(np.uint32) ^ b[start + offset : end + offset].view(np.uint32)
    return float(np.bitwise_count(x).sum()) / (32 * (end - start)), end - start


def _verified(pairs: DataFrame, most: float) -> DataFrame:
    """Those of ``pairs`` (query, found, offset, a, b) of which at most a share of ``most`` bits differ."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [batch.column(i).to_pylist() for i in range(3)]
            prints = [[x.values.to_numpy(zero_copy_only=False) for x in batch.column(i)] for i in (3, 4)]
            kept = []
            for q, r, at, a, b in zip(*ids, *prints, strict=True):
                errors, n = bit_errors(a, b, at)
                if n >= min(LEAST_OVERLAP, len(a), len(b)) and errors <= most:
                    kept.append((q, r, at, errors))
            columns = list(zip(*kept, strict=True)) or [[], [], [], []]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
            yield pa.record_batch([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], names=["query", "found", "offset", "errors"])

    return pairs.mapInArrow(run, "query long, found long, offset long, errors double")


def _compared(pairs: DataFrame, classes: DataFrame, most: float) -> DataFrame:
    a = classes.select(F.col("class_id").alias("query"), F.col("prints").alias("a"))
    b = classes.select(F.col("class_id").alias("found"), F.col("prints").alias("b"))
    return _verified(pairs.join(a, "query").join(b, "found").select("query", "found", "offset", "a", "b"), most)


def _alike(a: str, b: str) -> Column:
    """Whether the fingerprints beside two landmarks agree where both have them."""
    return F.expr(f"bit_count(({a}.beside ^ {b}.beside) & {a}.mask & {b}.mask) <= {MOST_BESIDE} * bit_count({a}.mask & {b}.mask)")


def groups(classes: DataFrame, index: DataFrame, scratch: Scratch) -> DataFrame:
    """(class_id, group_id, errors): classes whose fingerprints differ from those of their group's leader
    in at most half of ``MOST_ERRORS``, place by place, so that any two of a group match each other.

    Only the classes of a landmark key and the one of them that meets most others are compared, so a
    group of near copies costs a pair for each, not one for each two. Leaders and classes without a
    leader aren't listed.
    """
    often = index.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    met = scratch.write(index.join(often, "key"))
    score = met.groupBy("class_id").agg(F.sum("n").alias("score"))
    scored = met.join(score, "class_id").select("key", F.struct("score", "class_id", "place", "beside", "mask").alias("x"))
    pivot = scored.groupBy("key").agg(F.max_by("x", F.struct("x.score", -F.col("x.class_id"))).alias("p"))
    pairs = scored.join(pivot, "key").where("x.class_id <> p.class_id and x.place = p.place").where(_alike("x", "p"))
    pairs = pairs.select(F.col("x.class_id").alias("query"), F.col("p.class_id").alias("found"), F.lit(0).cast("long").alias("offset")).distinct()
    sizes = classes.select("class_id", F.size("prints").alias("n"))
    same = pairs.join(sizes.withColumnsRenamed({"class_id": "query", "n": "q"}), "query").join(sizes.withColumnsRenamed({"class_id": "found", "n": "f"}), "found").where("q = f")
    near = scratch.write(_compared(same, classes, MOST_ERRORS / 2))
    leaders = near.join(near.select(F.col("query").alias("found")).distinct(), "found", "left_anti")
    return leaders.groupBy(F.col("query").alias("class_id")).agg(F.min(F.struct("errors", "found")).alias("m")).select("class_id", F.col("m.found").alias("group_id"), F.col("m.errors").alias("errors"))


def search(recordings: DataFrame, queries: Column, id_col: str = "id", media: str = "media", decode: Decode = decode_wav) -> tuple[DataFrame, DataFrame]:
    """Members (id, class_id, group_id, is_query) of all recordings, and matches (query, found, offset,
    errors, inside) of the classes of queries with all classes outside their groups and, inside, with
    their leaders (a leader with the nearest of its group).

    Recordings with the same fingerprints are one class, called by its smallest id; classes that
    are nearly the same are a group, called by its leader: any two of a group match at offset 0.
    Every class is indexed by all its landmarks. A query's landmarks, with their least certain bits
    also changed, vote for offsets; the offset with most votes (the smallest of equals) is
    checked by its bit errors. Recordings without fingerprints are a class each, without matches; null
    ids are no queries and their classes are called null.
    """
    scratch = Scratch(recordings.sparkSession, "audio")
    model = fit_thresholds(recordings, media, decode)
    rows = recordings.select(F.col(id_col).cast("long").alias("id"), F.col(media).alias("media")).withColumn("is_query", F.coalesce(queries, F.lit(False)))
    made = scratch.write(fingerprints(rows, model, "media", decode).withColumn("print", F.when(F.size("prints") > 0, F.xxhash64("prints"))))
    heard = made.where("print is not null and id is not null")
    arrays = [x.split()[0] for x in _MADE]
    first = [F.first(F.when(F.col("is_query"), F.col("probes")), ignorenulls=True).alias(c) if c == "probes" else F.first(c).alias(c) for c in arrays]
    classes = scratch.write(heard.groupBy("print").agg(F.min("id").alias("class_id"), F.max("is_query").alias("asked"), *first))
    at = F.explode(F.arrays_zip("keys", "places", "beside", "masks")).alias("l")
    index = classes.select("class_id", at).selectExpr("class_id", "l.keys as key", "l.places as place", "l.beside as beside", "l.masks as mask")
    near = scratch.write(groups(classes, index, scratch))
    grouped = classes.join(near, "class_id", "left").select("print", "class_id", F.coalesce("group_id", "class_id").alias("group_id"))
    known = made.join(grouped, "print", "left")
    named = [F.when(F.col("print").isNull(), F.col("id")).otherwise(F.col(c)).alias(c) for c in ("class_id", "group_id")]
    members = known.select("id", *named, "is_query")

    of_group = grouped.select("class_id", "group_id")
    indexed = scratch.write(index.join(of_group, "class_id"))
    tried = classes.where("asked").select("class_id", "places", "beside", "masks", F.posexplode("probes").alias("j", "key"))
    i = F.expr(f"j div {1 << PROBED}").cast("int")
    asked = tried.select("class_id", "key", F.get("places", i).alias("place"), F.get("beside", i).alias("beside"), F.get("masks", i).alias("mask"))
    asked = asked.join(of_group, "class_id").withColumnsRenamed({"class_id": "query", "group_id": "own"})
    # A query meets groups first, so that members of its own are not met one by one.
    meets = asked.join(indexed.select("key", "group_id").distinct(), "key").where("own <> group_id").alias("q")
    met = meets.join(indexed.alias("r"), F.expr("q.key = r.key and q.group_id = r.group_id") & _alike("q", "r"))
    votes = met.groupBy("query", F.col("r.class_id").alias("found"), F.expr("r.place - q.place").alias("offset")).agg(F.count("*").alias("votes"))
    best = votes.groupBy("query", "found").agg(F.max_by("offset", F.struct("votes", -F.abs("offset"), -F.col("offset"))).alias("offset"))
    across = _compared(best, classes, MOST_ERRORS).withColumn("inside", F.lit(False))
    closest = near.groupBy("group_id").agg(F.min(F.struct("errors", "class_id")).alias("m")).select(F.col("group_id").alias("query"), F.col("m.class_id").alias("found"), "m.errors")
    inside = near.select(F.col("class_id").alias("query"), F.col("group_id").alias("found"), "errors").unionByName(closest)
    inside = inside.join(classes.where("asked").select(F.col("class_id").alias("query")), "query", "left_semi")
    return members, across.unionByName(inside.select("query", "found", F.lit(0).cast("long").alias("offset"), "errors", F.lit(True).alias("inside")))


def linked(recordings: DataFrame, queries: Column, id_col: str = "id", media: str = "media", decode: Decode = decode_wav) -> DataFrame:
    """(id, class_id, group_id, is_query, n_links, best_class, best_offset, best_errors): a row per recording.

    n_links counts the other classes that its class, if a query's, matches: the others of its group
    and those outside. The best (fewest bit errors, then smallest id) is of those outside and, of
    the group, its leader (for a leader, the nearest). Other rows have 0 and nulls. Null media, repeated rows and an empty table are
    rows, one class and no rows; other columns are not read, whatever their names.
    """
    members, matches = search(recordings, queries, id_col, media, decode)
    members = members.withColumnsRenamed({"class_id": "c", "group_id": "g"})
    sizes = members.select("c", "g").distinct().groupBy("g").agg((F.count("*") - 1).alias("others")).withColumnRenamed("g", "g2")
    per = matches.groupBy("query").agg(F.sum(F.when(F.col("inside"), 0).otherwise(1)).alias("n"), F.min(F.struct("errors", "found", "offset")).alias("m"))
    asked = members.groupBy("c").agg(F.max("is_query").alias("asked")).withColumnRenamed("c", "c2")
    out = members.join(asked, F.col("c") == F.col("c2"), "left").join(sizes, F.col("g") == F.col("g2"), "left").join(per, F.col("c") == F.col("query"), "left")
    n = F.when(F.col("asked"), F.coalesce("n", F.lit(0)) + F.coalesce("others", F.lit(0))).otherwise(0).cast("long")
    return out.select("id", F.col("c").alias("class_id"), F.col("g").alias("group_id"), "is_query", n.alias("n_links"), F.col("m.found").alias("best_class"), F.col("m.offset").alias("best_offset"), F.round("m.errors", 6).alias("best_errors"))


def render_vector(values: list[float] | None, rate: int = 2000, note: int = 128) -> tuple[np.ndarray, int]:
    """A recording of a vector, for tables that have no media: a chord of twelve pitch classes for
    each run of twelve values, as loud as they are large. Nulls and odd values are 0."""
    v = np.nan_to_num(np.array([0.0 if x is None else x for x in values or []], float), posinf=0, neginf=0)
    if len(v) < PITCHES:
        return np.zeros(0), rate
    chords = np.exp(4 * np.clip(np.lib.stride_tricks.sliding_window_view(v, PITCHES), -1, 1))
    t = np.arange(len(chords) * note)
    tones = np.sin(2 * np.pi * 440 * 2 ** ((np.arange(PITCHES)[:, None] - 6) / 12) * t / rate + np.arange(PITCHES)[:, None])
    return (chords.T.repeat(note, axis=1) * tones).sum(axis=0), rate
