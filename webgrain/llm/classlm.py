"""Scores of a class-based n-gram language model (Brown clustering by exchange).

The probability of a word is that of its class after the class of the word before, times that of the
word in its class. Classes are found by exchange: a word moves to the class that raises the
likelihood of the class bigrams most. The most frequent words are exchanged one after the other until
no move helps; meanwhile all others stand in the class of their ending. Then each of these others, however
rare, is exchanged by its own exact counts, all at once (``exchange_rest``). Every word keeps its own
count for its emission; only words that were never learnt are in the class of their ending.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from webgrain.llm import windows as W
from webgrain.llm.common import stored

END = W.mixed(np.array([77], np.uint64))[0]  # the end of a text, as a token
OWN = 1024  # words that are exchanged one after the other: bounds the table of bigrams
ENDINGS = 256  # groups of all other words, by their last two bytes: where their exchange begins
UNITS = OWN + ENDINGS + 1  # and the end of a text
FREQUENT = 1 << 17  # words whose counts and classes every task holds; all others are joined
CHUNK = 512  # words whose gains are computed at a time
ADD = 0.5  # to the count of a word, known or not


def _tokens(column: pa.Array):
    """Fingerprints of the tokens of all texts (A-Z lower-cased, one end per text), the group of
    their ending, and the offsets of the texts."""
    raw, offsets = W.text_bytes(column)
    raw = np.where((raw >= 65) & (raw <= 90), raw + np.uint8(32), raw).astype(np.uint8)
    words, starts, ends, counts = W.word_units(raw, offsets)
    last = raw[ends - 1].astype(np.int64) if len(words) else np.zeros(0, np.int64)
    prior = np.where(ends - starts > 1, raw[np.maximum(ends - 2, 0)], 0).astype(np.int64) if len(words) else last
    group = (last * 31 + prior) % ENDINGS
    n = len(offsets) - 1
    where = counts[1:] + np.arange(n)  # places of the ends
    tokens = np.empty(len(words) + n, np.uint64)
    groups = np.full(len(words) + n, -1, np.int64)
    word = np.ones(len(tokens), bool)
    word[where] = False
    tokens[word], tokens[where] = words, END
    groups[word] = group
    return tokens, groups, counts + np.arange(n + 1)


def _lookup(keys: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Place of each token in the sorted keys, or -1."""
    if not len(keys):
        return np.full(len(tokens), -1)
    at = np.searchsorted(keys, tokens)
    at[at == len(keys)] = 0
    return np.where(keys[at] == tokens, at, -1)


def _units(own: np.ndarray, tokens: np.ndarray, groups: np.ndarray) -> np.ndarray:
    at = _lookup(own, tokens)
    return np.where(groups < 0, UNITS - 1, np.where(at >= 0, at, OWN + groups))


def count_words(texts: DataFrame) -> DataFrame:
    """(token, ending, c) of all tokens of the column ``t``; counted per batch first."""

    def step(batches):
        for batch in W.slices(batches, "t"):
            tokens, groups, _ = _tokens(batch.column(0))
            found, first, n = np.unique(tokens, return_index=True, return_counts=True)
            yield pa.record_batch([pa.array(found.view(np.int64)), pa.array(groups[first]), pa.array(n, pa.int64())],
                                  names=["token", "ending", "c"])

    return texts.select("t").mapInArrow(step, "token long, ending long, c long").groupBy("token", "ending").agg(
        F.sum("c").alias("c"))


def count_bigrams(texts: DataFrame, own) -> DataFrame:
    """(pair, n) of neighbouring units, pair = first * UNITS + second. The unit before a text is the
    end of a text."""

    def step(batches):
        for batch in W.slices(batches, "t"):
            tokens, groups, offsets = _tokens(batch.column(0))
            unit = _units(own.value, tokens, groups)
            before = np.empty_like(unit)
            before[1:] = unit[:-1]
            before[offsets[:-1]] = UNITS - 1
            pair, n = np.unique(before * UNITS + unit, return_counts=True)
            yield pa.record_batch([pa.array(pair), pa.array(n, pa.int64())], names=["pair", "n"])

    return texts.select("t").mapInArrow(step, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def _h(x):
    return np.where(x > 0, x * np.log(np.maximum(x, 1)), 0.0)


def gains(both: np.ndarray, r: np.ndarray, c: np.ndarray, own: float) -> np.ndarray:
    """What the log likelihood gains, up to a constant, when a unit joins each of the classes. ``both``
    are the class bigrams without the unit, r those from the unit into the classes, c those from the
    classes into the unit, ``own`` those of the unit with itself."""
    rows, cols, d = both.sum(1), both.sum(0), both.diagonal()
    nr, nc = r.sum() + own, c.sum() + own
    gain = (_h(both + r[None, :]) - _h(both)).sum(1) + (_h(both + c[:, None]) - _h(both)).sum(0)
    gain += _h(d + r + c + own) - _h(d + r) - _h(d + c) + _h(d)
    # the class also gets the links of the unit with its own members
    return gain - (_h(rows + c + nr) - _h(rows + c) + _h(cols + r + nc) - _h(cols + r))


def exchange(pairs: np.ndarray, classes: int, sweeps: int) -> np.ndarray:
    """Class of every unit from the matrix of unit bigrams (UNITS x UNITS; of a fixed size). The end
    of a text keeps a class of its own, the last one."""
    size = len(pairs)
    weight = pairs.sum(0) + pairs.sum(1)
    order = np.argsort(-weight[:-1], kind="stable")
    of = np.empty(size, np.int64)
    of[order] = np.arange(size - 1) % (classes - 1)
    of[-1] = classes - 1

    one = np.eye(classes)
    for _ in range(sweeps):
        moved = 0
        member = one[of]
        right = pairs @ member  # unit before, class after
        left = member.T @ pairs  # class before, unit after
        both = member.T @ right
        for u in order:
            if not weight[u]:
                continue
            a, own = of[u], pairs[u, u]
            r, c = right[u].copy(), left[:, u].copy()
            r[a] -= own
            c[a] -= own
            # counts without the unit
            both[a, :] -= r
            both[:, a] -= c
            both[a, a] -= own
            gain = gains(both, r, c, own)
            gain[-1] = -np.inf
            b = int(np.argmax(gain))
            if gain[b] <= gain[a] + 1e-9:
                b = a
            both[b, :] += r
            both[:, b] += c
            both[b, b] += own
            if b != a:
                moved += 1
                of[u] = b
                right[:, a] -= pairs[:, u]
                right[:, b] += pairs[:, u]
                left[a, :] -= pairs[u, :]
                left[b, :] += pairs[u, :]
        if not moved:
            break
    return of


def _blobs(numbers: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A column of binaries, one for each range of the numbers."""
    cuts = (offsets * numbers.itemsize).astype(np.int64)
    return pa.Array.from_buffers(
        pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(numbers)]).cast(pa.binary())


def _binaries(column: pa.Array, kind) -> tuple[np.ndarray, np.ndarray]:
    """The numbers in a column of binaries, and the offsets of its rows."""
    sizes = np.asarray(pc.binary_length(column)).astype(np.int64) // np.dtype(kind).itemsize
    return np.frombuffer(b"".join(x.as_buffer() for x in column), kind), np.concatenate([[0], np.cumsum(sizes)])


def count_contexts(texts: DataFrame, own, of, classes: int) -> DataFrame:
    """(token, ending, blobs) of all words but the ``own`` ones: how often each class stands before (code =
    class), behind (``classes`` + class) and the word beside itself (twice ``classes``). A blob has the
    counts of some texts, as numbers n * (2 * classes + 1) + code."""
    codes = 2 * classes + 1
    most = (1 << 32) // codes - 1

    def step(batches):
        for batch in W.slices(batches, "t"):
            tokens, groups, offsets = _tokens(batch.column(0))
            unit = _units(own.value, tokens, groups)
            cls = of.value[unit]
            at = np.flatnonzero((unit >= OWN) & (groups >= 0))  # an end of a text stands behind each word
            if not len(at):
                continue
            kinds, first, where = np.unique(tokens[at], return_index=True, return_inverse=True)
            start = np.zeros(len(tokens), bool)
            start[offsets[:-1]] = True
            before = np.where(start[at], classes - 1, cls[at - 1])
            twin = ~start[at] & (tokens[at - 1] == tokens[at])  # the word stands before itself
            heads = tokens[at + 1] == tokens[at]
            keys, n = np.unique(np.concatenate([
                where * codes + np.where(twin, 2 * classes, before),
                (where * codes + classes + cls[at + 1])[~heads]]), return_counts=True)
            parts = -(-n // most)
            keys, n = np.repeat(keys, parts), np.repeat(n // parts, parts) + (
                np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts) < np.repeat(n % parts, parts))
            packed = (n * codes + keys % codes).astype(np.uint32)
            blobs = _blobs(packed, np.searchsorted(keys, np.arange(len(kinds) + 1) * codes))
            yield pa.record_batch([pa.array(kinds.view(np.int64)), pa.array(groups[at][first]), blobs],
                                  names=["token", "ending", "b"])

    return texts.select("t").mapInArrow(step, "token long, ending long, b binary").groupBy("token", "ending").agg(
        F.collect_list("b").alias("blobs"))


def best_classes(both: np.ndarray, contexts: np.ndarray, of: np.ndarray) -> np.ndarray:
    """The class that raises the likelihood most for each of some words, each as if it alone moved out of its
    class ``of``. ``contexts`` (words x codes) are the counts of ``count_contexts``. The same gains as
    those of ``gains``, at the classes only that a word has beside it."""
    classes = len(both)
    c, r, own = contexts[:, :classes], contexts[:, classes:2 * classes], contexts[:, 2 * classes]
    nr, nc = r.sum(1) + own, c.sum(1) + own
    i = np.arange(len(of))
    gain = np.zeros((len(of), classes))
    for out, back, table in ((r, c, both.T), (c, r, both)):
        word, k = np.nonzero(out)
        if not len(word):
            continue
        x = out[word, k]
        held = table[k]
        same = of[word] == k
        held[same] -= back[word[same]]
        held[np.arange(len(word)), of[word]] -= x + np.where(same, own[word], 0)
        some, first = np.unique(word, return_index=True)
        gain[some] += np.add.reduceat(_h(held + x[:, None]) - _h(held), first, axis=0)
    d = np.tile(both.diagonal(), (len(of), 1))
    d[i, of] -= r[i, of] + c[i, of] + own
    gain += _h(d + r + c + own[:, None]) - _h(d + r) - _h(d + c) + _h(d)
    for total, n in ((both.sum(1), nr), (both.sum(0), nc)):
        rest = np.tile(total, (len(of), 1))
        rest[i, of] -= n
        gain -= _h(rest + n[:, None]) - _h(rest)
    gain[:, -1] = -np.inf
    best = gain.argmax(1)
    return np.where(gain[i, best] > gain[i, of] + 1e-9, best, of)


def exchange_rest(counted: DataFrame, both: np.ndarray, of: np.ndarray) -> DataFrame:
    """(token, c, class) of the words of ``count_contexts``: each moves from the class of its ending to its
    best one, given the classes that all others begin with."""
    shared = counted.sparkSession.sparkContext.broadcast((both, of))
    codes = 2 * len(both) + 1

    def step(batches):
        for batch in batches:
            table, begin = shared.value
            for a in range(0, batch.num_rows, CHUNK):
                part = batch.slice(a, CHUNK)
                lists = part.column(2)
                counts = np.asarray(lists.value_lengths())
                packed, cuts = _binaries(lists.flatten(), np.uint32)
                packed = packed.astype(np.int64)
                row = np.repeat(np.repeat(np.arange(part.num_rows), counts), np.diff(cuts))
                contexts = np.bincount(row * codes + packed % codes, weights=packed // codes, minlength=part.num_rows * codes)
                contexts = contexts.reshape(part.num_rows, codes)
                c = contexts[:, :len(table)].sum(1) + contexts[:, -1]
                now = best_classes(table, contexts, begin[OWN + np.asarray(part.column(1))])
                yield pa.record_batch([part.column(0), pa.array(c.astype(np.int64)), pa.array(now.astype(np.int32))],
                                      names=["token", "c", "class"])

    return counted.mapInArrow(step, "token long, c long, class int")


def learn(texts: DataFrame, classes: int = 64, sweeps: int = 8, frequent: int = FREQUENT):
    """(vocabulary, rest, model) of the texts in column ``t``: the stored tables (token, ending, c) of every
    word and (token, c, class) of all but the ``own`` ones, and arrays of fixed size, without the
    transitions."""
    spark = texts.sparkSession
    vocabulary = stored(count_words(texts), "vocabulary")
    total, distinct = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    top = vocabulary.filter("ending >= 0").orderBy(F.desc("c"), "token").limit(OWN).toPandas()
    own = np.sort(top["token"].to_numpy(np.int64).view(np.uint64))
    shared = spark.sparkContext.broadcast(own)
    counted = count_bigrams(texts, shared).toPandas()
    pairs = np.zeros(UNITS * UNITS)
    pairs[counted["pair"].to_numpy(np.int64)] = counted["n"].to_numpy(np.int64)
    pairs = pairs.reshape(UNITS, UNITS)
    of = exchange(pairs, classes, sweeps)
    member = np.eye(classes)[of]
    both = member.T @ pairs @ member
    rest = stored(exchange_rest(count_contexts(texts, shared, spark.sparkContext.broadcast(of), classes), both, of), "classes")
    # per class the tokens and distinct words
    n, v = np.zeros(classes), np.zeros(classes)
    alone = np.r_[0:len(own), UNITS - 1]
    np.add.at(n, of[alone], pairs.sum(0)[alone])
    np.add.at(v, of[alone], 1)
    for cls, some, kinds in rest.groupBy("class").agg(F.sum("c"), F.count("*")).collect():
        n[cls] += some
        v[cls] += kinds
    # the words of the largest counts, cut at a count: ties with it are joined, so that no partition sends its own list
    share = max(0, frequent - OWN) / max(1, int(v.sum()))
    cut = rest.agg(F.percentile_approx("c", 1 - min(1.0, share), 10000)).first()[0] or 0
    held = (rest if share >= 1 else rest.filter(F.col("c") > cut)).toPandas()
    tokens = np.concatenate([own, held["token"].to_numpy(np.int64).view(np.uint64)])
    order = np.argsort(tokens, kind="stable")
    return vocabulary, rest, {
        "own": own, "of": of, "n": n, "v": v, "total": int(total), "distinct": int(distinct), "frequent": tokens[order],
        "counts": np.concatenate([pairs.sum(0)[:len(own)].astype(np.int64), held["c"].to_numpy(np.int64)])[order],
        "class": np.concatenate([of[:len(own)], held["class"].to_numpy(np.int64)])[order], "ends": int(pairs[:, -1].sum()),
    }


def _sums(offsets: np.ndarray, x: np.ndarray) -> np.ndarray:
    return np.bincount(np.repeat(np.arange(len(offsets) - 1), np.diff(offsets)), weights=x, minlength=len(offsets) - 1)


def _kind(classes: int):
    return np.uint8 if 2 * classes <= 256 else np.uint16


def tagged(docs: DataFrame, rest: DataFrame, model: dict) -> DataFrame:
    """The columns of ``docs`` but t, and n_tokens, known, base, emit (log10 of the words, in the corpus and
    in their classes) and seq, the classes of all tokens; stored.

    Frequent words are looked up where the text is. The others are joined with ``rest`` and put back in
    their places.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in docs.columns if c != "t"]
    classes, kind = len(model["n"]), _kind(len(model["n"]))
    columns = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in docs.schema if f.name != "t")
    sums = "n_tokens long, known long, base double, emit double"

    def logs(m, c, cls):
        return np.log10((c + ADD) / (m["total"] + ADD * (m["distinct"] + 1))), np.log10(
            (c + ADD) / (m["n"][cls] + ADD * (m["v"][cls] + 1)))

    def look(batches):
        m = shared.value
        for batch in W.slices(batches, "t"):
            tokens, groups, offsets = _tokens(batch.column(batch.schema.get_field_index("t")))
            at = _lookup(m["frequent"], tokens)
            end = groups < 0
            held = (at >= 0) | end
            cls = np.where(end, classes - 1, m["of"][OWN + groups])
            cls[at >= 0] = m["class"][at[at >= 0]]
            c = np.where(end, m["ends"], 0)
            c[at >= 0] = m["counts"][at[at >= 0]]
            base, emit = logs(m, c, cls)
            seq = (cls + np.where(held, 0, classes)).astype(kind)  # marked: to be joined
            blobs = _blobs(seq, offsets)
            far = np.flatnonzero(~held)
            lists = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(far, offsets).astype(np.int32)), pa.array(tokens[far].view(np.int64)))
            yield pa.record_batch(
                [*[batch.column(batch.schema.get_field_index(k)) for k in keep], pa.array(np.diff(offsets)),
                 pa.array(_sums(offsets, held & (c > 0)).astype(np.int64)), pa.array(_sums(offsets, np.where(held, base, 0.0))),
                 pa.array(_sums(offsets, np.where(held, emit, 0.0))), blobs, lists],
                names=[*keep, "n_tokens", "known", "base", "emit", "seq", "token"])

    looked = stored(docs.mapInArrow(look, f"{columns}{sums}, seq binary, token array<long>").withColumn(
        "_row", F.monotonically_increasing_id()), "looked")
    found = (
        looked.select("_row", F.posexplode("token").alias("j", "token"))
        .join(rest.select("token", (F.col("c") * classes + F.col("class")).alias("x")), "token")
        .select(F.col("_row").alias("_r"), "j", "x").repartition("_r")
        .groupBy("_r").agg(F.collect_list(F.struct("j", "x")).alias("_found")))

    def fill(batches):
        m = shared.value
        for batch in W.slices(batches, "seq"):
            column = lambda name: batch.column(batch.schema.get_field_index(name))
            seq, offsets = _binaries(column("seq"), kind)
            seq = seq.copy()
            far = np.flatnonzero(seq >= classes)
            cuts = np.searchsorted(far, offsets)
            lists = column("_found")
            flat = lists.flatten()
            at = np.asarray(flat.field(0)) + np.repeat(cuts[:-1], np.asarray(lists.value_lengths().fill_null(0)))
            x = np.asarray(flat.field(1))
            c = np.zeros(len(far), np.int64)
            seq[far] -= kind(classes)
            seq[far[at]], c[at] = x % classes, x // classes
            base, emit = logs(m, c, seq[far])
            added = [_sums(cuts, y) for y in (c > 0, base, emit)]
            yield pa.record_batch(
                [*[column(k) for k in keep], column("n_tokens"),
                 pa.array(np.asarray(column("known")) + added[0].astype(np.int64)),
                 pa.array(np.asarray(column("base")) + added[1]), pa.array(np.asarray(column("emit")) + added[2]), _blobs(seq, offsets)],
                names=[*keep, "n_tokens", "known", "base", "emit", "seq"])

    joined = looked.drop("token").join(found, F.col("_row") == F.col("_r"), "left").drop("_row", "_r")
    return stored(joined.mapInArrow(fill, f"{columns}{sums}, seq binary"), "tagged")


def _neighbours(seq, offsets, classes):
    before = np.empty(len(seq), np.int32)
    before[1:] = seq[:-1]
    before[offsets[:-1]] = classes - 1  # the unit before a text is the end of a text
    return before * classes + seq


def transitions(tags: DataFrame, classes: int) -> np.ndarray:
    """log10 of the probability of a class after another, smoothed with the frequency of the class."""

    def step(batches):
        for batch in W.slices(batches, "seq"):
            pair = _neighbours(*_binaries(batch.column(0), _kind(classes)), classes)
            n = np.bincount(pair, minlength=classes * classes)
            some = np.flatnonzero(n)
            yield pa.record_batch([pa.array(some), pa.array(n[some])], names=["pair", "n"])

    both = np.zeros(classes * classes)
    for pair, n in tags.select("seq").mapInArrow(step, "pair long, n long").groupBy("pair").agg(F.sum("n")).collect():
        both[pair] = n
    both = both.reshape(classes, classes)
    share = (both.sum(0) + 1) / (both.sum() + classes)
    return np.log10((both + 10 * share) / (both.sum(1, keepdims=True) + 10))


def fit(texts: DataFrame, classes: int = 64, sweeps: int = 8):
    """(vocabulary, model) of the texts in column ``t``. The vocabulary is a stored table (token,
    ending, c) of every word; the model has arrays of fixed size, and ``rest``, the stored table (token, c,
    class) of the words that ``own`` does not list."""
    vocabulary, rest, model = learn(texts, classes, sweeps)
    return vocabulary, model | {"transition": transitions(tagged(texts.select("t"), rest, model), classes), "rest": rest}


def score(tags: DataFrame, transition: np.ndarray) -> DataFrame:
    """The columns of ``tagged``, known as n_known, base_score and score in place of its sums and classes."""
    shared = tags.sparkSession.sparkContext.broadcast(transition)
    classes = len(transition)
    keep = [c for c in tags.columns if c not in ("known", "base", "emit", "seq")]

    def step(batches):
        flat = shared.value.ravel()
        for batch in W.slices(batches, "seq"):
            column = lambda name: batch.column(batch.schema.get_field_index(name))
            seq, offsets = _binaries(column("seq"), _kind(classes))
            part = _sums(offsets, flat[_neighbours(seq, offsets, classes)])
            yield pa.record_batch(
                [*[column(k) for k in keep], column("known"), column("base"), pa.array(np.asarray(column("emit")) + part)],
                names=[*keep, "n_known", "base_score", "score"])

    columns = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in tags.schema if f.name in keep)
    return tags.mapInArrow(step, f"{columns}n_known long, base_score double, score double")


def score_held_out(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", folds: int = 5, held_fold: int = 1,
                   classes: int = 64) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of ``docs``.

    Learns from the documents whose crc32 of the id as text leaves another remainder than
    ``held_fold`` (a null id counts as an empty text), and scores all. ``score`` is the log10
    probability of the text and its end under the class model; -score / n_tokens is the log10 of the
    perplexity. Null and empty texts have the end as their one token. Repeated rows are learnt as
    often as they stand and scored alike. Without rows to learn from every count is zero; an empty
    table gives an empty result. Texts are used whole; other columns are not read.
    """
    fold = F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(folds))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), (fold == held_fold).alias("held_out"), F.col(text).cast("string").alias("t"))
    _, rest, model = learn(rows.filter("not held_out"), classes)
    tags = tagged(rows, rest, model)
    return score(tags, transitions(tags.filter("not held_out"), classes)).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(model["total"]).cast("long").alias("train_tokens"),
        "base_score", "score")
