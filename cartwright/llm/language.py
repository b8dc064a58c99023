"""Language of documents by a linear-chain conditional random field over their words.

Every word has affix, character n-gram and lexicon features; learned weights give it a score per language, learned transitions
tie neighbours together, and forward-backward gives the chance of each language at each word, so text that switches language
is labelled word by word. Training is on a bounded sample of every language: DOCS_PER_LANGUAGE distinct labelled documents at most,
those with the least hash of doc_id and text. Runs of words of different documents are joined into training sequences that switch
language, so that words have to speak for themselves. Training and prediction read whole texts.

A word of more than LONGEST characters, as in scripts without spaces, is cut into consecutive pieces of that many at most, and
each piece takes part like a word, so that every character counts.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from cartwright.llm import frames

UNKNOWN = "und"
DOCS_PER_LANGUAGE = 300
#: Documents that training collects in all; beyond 64 languages each has an even share of them, one document at least.
SAMPLE = 64 * DOCS_PER_LANGUAGE
BUCKETS = 1 << 15
LEXICON_WORDS = 400
LONGEST = 24
#: Bytes of text labelled together with up to four languages, less with more; forward-backward takes about 35 times that in memory.
SLICE = 3 << 20
#: Runs of a few words, of different documents, make a training sequence.
RUN, RUNS = 12, 8
EPOCHS, BATCH, RATE, DECAY = 6, 512, 0.5, 0.02
_SIGNS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~0123456789«»“”„‘’…–—¿¡"


def has_letter(text):
    return text.lower() != text.upper() or any(sign.isalpha() for sign in text)


def _core(token):
    """A token without the signs around it, lower-cased; empty if no letter is left."""
    word = token.strip(_SIGNS).lower()
    return word if has_letter(word) else ""


def _pieces(token):
    """The core of a token in pieces of at most LONGEST characters; those without a letter are empty."""
    word = _core(token)
    if len(word) <= LONGEST:
        return [word]
    return [piece if has_letter(piece) else "" for piece in (word[i : i + LONGEST] for i in range(0, len(word), LONGEST))]


def _hash(columns, salt):
    total = np.full(len(columns[0]), salt * 0x9E3779B1 + 12345, np.uint64)
    for column in columns:
        total = (total ^ column) * np.uint64(0x100000001B3)
        total ^= total >> np.uint64(29)
    return (total >> np.uint64(7)) % np.uint64(BUCKETS)


def word_features(words):
    """Feature buckets, words x features; BUCKETS stands for no feature. Words of any length: as wide as the longest."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    width = max(3, int(lengths.max(initial=0)))
    codes = np.array(words, f"<U{width}").view(np.uint32).reshape(len(words), width).astype(np.uint64)
    columns = []

    def add(parts, salt, valid):
        columns.append(np.where(valid, _hash(parts, salt), BUCKETS))

    last = lengths - 1
    rows = np.arange(len(words))
    for size in (1, 2, 3):
        add([codes[:, i] for i in range(size)], size, lengths >= size)
        add([codes[rows, np.maximum(last - i, 0)] for i in range(size)], 8 + size, lengths >= size)
    for start in range(width - 1):
        if not (lengths > start + 1).any():
            break
        add([codes[:, start], codes[:, start + 1]], 20, lengths > start + 1)
        if start + 2 < width:
            add([codes[:, start + i] for i in range(3)], 21, lengths > start + 2)
    return np.stack(columns, axis=1).astype(np.int32)


def _packed(lengths):
    """Order of sequences (longest first), and per step how many are still running and where their rows begin."""
    order = np.argsort(-lengths, kind="stable")
    longest = int(lengths[order[0]]) if len(lengths) else 0
    running = len(lengths) - np.searchsorted(np.sort(lengths), np.arange(longest), side="right")
    return order, running, np.concatenate([[0], np.cumsum(running)])


def forward_backward(scores, lengths, transitions):
    """Chances of each label at each position, and of each label pair in sum, for sequences laid end to end.

    All sequences advance together, one position per step, so the work per step is one small matrix product.
    """
    order, running, offsets = _packed(lengths)
    begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])[order]
    places = np.empty(len(scores), np.int64)
    for step, count in enumerate(running.tolist()):
        places[offsets[step] : offsets[step + 1]] = begins[:count] + step
    weights = scores[places]
    weights = np.exp(weights - weights.max(axis=1, keepdims=True))
    moves = np.exp(transitions - transitions.max())
    ahead, behind = np.empty_like(weights), np.empty_like(weights)
    state = None
    for step, count in enumerate(running.tolist()):
        here = slice(offsets[step], offsets[step + 1])
        state = weights[here] if state is None else (state[:count] @ moves) * weights[here]
        state = state / state.sum(axis=1, keepdims=True)
        ahead[here] = state
    pairs = np.zeros_like(moves)
    state = np.zeros((0, weights.shape[1]))
    for step in range(len(running) - 1, -1, -1):
        here = slice(offsets[step], offsets[step + 1])
        now = np.ones((running[step], weights.shape[1]))
        if len(state):
            after = state * weights[offsets[step + 1] : offsets[step + 2]]
            now[: len(state)] = after @ moves.T
            joint = ahead[here][: len(state)].T @ (after / (ahead[here][: len(state)] * now[: len(state)]).sum(axis=1, keepdims=True))
            pairs += joint * moves
        now /= now.sum(axis=1, keepdims=True)
        behind[here] = now
        state = now
    chances = ahead * behind
    chances /= chances.sum(axis=1, keepdims=True)
    out = np.empty_like(chances)
    out[places] = chances
    return out, pairs


class Model:
    """Weights per feature and label, lexicon, transitions. `labels` are sorted."""

    def __init__(self, labels, lexicon):
        self.labels, self.lexicon = labels, lexicon
        self.weights = np.zeros((BUCKETS + 1 + len(labels), len(labels)))
        self.transitions = np.zeros((len(labels), len(labels)))

    def features(self, words):
        """Feature rows of words, the lexicon's included; a word without letters has none."""
        named = np.fromiter((self.lexicon.get(word, -1) for word in words), np.int64, len(words))
        lexical = np.where(named >= 0, BUCKETS + 1 + named, BUCKETS)
        found = np.column_stack([word_features(words), lexical])
        found[np.fromiter((not word for word in words), bool, len(words))] = BUCKETS
        return found

    def scores(self, words):
        total = np.zeros((len(words), len(self.labels)))
        for start in range(0, len(words), 20_000):
            for column in self.features(words[start : start + 20_000]).T:
                total[start : start + 20_000] += self.weights[column]
        return total


def _lexicon(labelled, labels):
    """The words that are most one language's own: the LEXICON_WORDS most frequent of those it holds nine tenths of."""
    counts = {}
    for label, words in labelled:
        for word in words:
            per = counts.setdefault(word, {})
            per[label] = per.get(label, 0) + 1
    owned = [[] for _ in labels]
    for word, per in counts.items():
        label = max(per, key=per.get)
        if word and per[label] >= 3 and per[label] * 10 >= 9 * sum(per.values()):
            owned[label].append((-per[label], word))
    lexicon = {}
    for label, own in enumerate(owned):
        lexicon.update((word, label) for _, word in sorted(own)[:LEXICON_WORDS])
    return lexicon


def fit(rows, seed=7):
    """A model from (lang, text) rows, or (lang, list of texts) rows, each text its own sequence; None without rows."""
    labels = sorted({lang for lang, _ in rows})
    if not labels:
        return None
    numbers = {lang: label for label, lang in enumerate(labels)}
    texts = [(lang, text) for lang, given in rows for text in ([given] if isinstance(given, str) else given)]
    labelled = [(numbers[lang], [piece for token in text.split() for piece in _pieces(token)]) for lang, text in texts]
    model = Model(labels, _lexicon(labelled, labels))
    chance = np.random.default_rng(seed)
    vocabulary = {}
    coded = []
    for label, words in labelled:
        numbers = np.array([vocabulary.setdefault(word, len(vocabulary)) for word in words if word], np.int64)
        coded += [(label, numbers[start : start + RUN]) for start in range(0, len(numbers), RUN)]
    if not coded:
        return model
    features = model.features(list(vocabulary))
    squares, move_squares = np.ones_like(model.weights), np.ones_like(model.transitions)
    for _ in range(EPOCHS):
        order = chance.permutation(len(coded))
        for start in range(0, len(order), BATCH):
            chosen = [coded[i] for i in order[start : start + BATCH]]
            words = np.concatenate([words for _, words in chosen])
            truth = np.concatenate([np.full(len(words), label) for label, words in chosen])
            lengths = [sum(len(words) for _, words in chosen[i : i + RUNS]) for i in range(0, len(chosen), RUNS)]
            used, place = np.unique(words, return_inverse=True)
            scores = np.zeros((len(used), len(labels)))
            for column in features[used].T:
                scores += model.weights[column]
            lengths = np.array(lengths)
            chances, pairs = forward_backward(scores[place], lengths, model.transitions)
            chances[np.arange(len(truth)), truth] -= 1
            slopes = np.zeros_like(scores)
            np.add.at(slopes, place, chances)
            slope = np.zeros_like(model.weights)
            flat, columns = features[used].ravel(), features.shape[1]
            for label in range(len(labels)):
                slope[:, label] = np.bincount(flat, np.repeat(slopes[:, label], columns), len(slope))
            slope += DECAY * model.weights
            squares += slope * slope
            model.weights -= RATE * slope / np.sqrt(squares)
            model.weights[BUCKETS] = 0
            ends = np.cumsum(lengths)[:-1]
            inside = np.ones(len(truth), bool)
            inside[0] = False
            inside[ends] = False
            seen = np.zeros_like(pairs)
            np.add.at(seen, (truth[:-1][inside[1:]], truth[1:][inside[1:]]), 1)
            slope = pairs - seen + DECAY * model.transitions
            move_squares += slope * slope
            model.transitions -= RATE * slope / np.sqrt(move_squares)
    return model


def train_rows(docs, held_out):
    """The bounded training sample as (lang, text) rows, from documents that aren't held out and have text and lang.

    Every language takes part, with its documents of the least hashes. Copies of a document under one doc_id are one document.
    A first cut by the hash leaves about twice as many as wanted, so that ranking them is little work.
    """
    usable = docs.select("doc_id", "text", "lang").filter(~held_out & F.col("text").isNotNull() & F.col("lang").isNotNull())
    usable = usable.withColumn("digest", F.xxhash64("doc_id", "text"))
    counts = usable.groupBy("lang").agg(F.approx_count_distinct("digest").alias("count")).collect()
    if not counts:
        return []
    quota = max(1, min(DOCS_PER_LANGUAGE, SAMPLE // len(counts)))
    share = F.create_map([F.lit(x) for row in counts for x in (row["lang"], min(1.0, (2 * quota + 40) / max(1, row["count"])))])
    # Position of the document in [0, 1) by its hash: the same documents at every layout.
    place = F.pmod(F.col("digest"), F.lit(1 << 30)) / float(1 << 30)
    chosen = usable.withColumn("place", place).filter(F.col("place") < share[F.col("lang")])
    chosen = chosen.groupBy("lang", "place", "digest").agg(F.min("text").alias("text"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place", "digest"))
    rows = chosen.withColumn("rank", rank).filter(F.col("rank") <= quota).select("lang", "text").collect()
    return sorted((row["lang"], row["text"]) for row in rows)


class _Numbers(dict):
    """Numbers words in the order of their first appearance."""

    def __missing__(self, word):
        self[word] = number = len(self)
        return number


def _spread(codes, begins, counts):
    """Numbers of pieces in place of numbers of tokens."""
    many = counts[codes]
    ends = np.cumsum(many)
    return np.repeat(begins[codes] - (ends - many), many) + np.arange(many.sum())


def _posteriors(model, values):
    """Per text: its words, long ones in pieces, and the chances of each language at each that has a letter."""
    tokens = [text.split() for text in values]
    known = _Numbers()
    coded = [np.fromiter(map(known.__getitem__, words), np.int64, len(words)) for words in tokens]
    pieces = [_pieces(token) for token in known]
    cores = [piece for found in pieces for piece in found]
    counts = np.fromiter(map(len, pieces), np.int64, len(pieces))
    if len(cores) > len(pieces):
        begins = np.cumsum(counts) - counts
        coded = [_spread(codes, begins, counts) for codes in coded]
    lettered = np.fromiter(map(bool, cores), bool, len(cores))
    coded = [codes[lettered[codes]] if len(codes) else codes for codes in coded]
    lengths = np.fromiter(map(len, coded), np.int64, len(coded))
    some = np.nonzero(lengths)[0]
    if not len(some):
        return tokens, cores, coded, lengths, np.zeros((0, len(model.labels)))
    scores = model.scores(cores)
    chances, _ = forward_backward(scores[np.concatenate([coded[i] for i in some])], lengths[some], model.transitions)
    return tokens, cores, coded, lengths, chances


def _slice(model):
    """Bytes of text labelled together, in step with the number of chances per word."""
    return max(1, 4 * SLICE // max(4, len(model.labels) if model else 0))


def predict_texts(model, values):
    """(language, score) per text: the language with the largest mean chance over the words, and that mean."""
    _, _, _, lengths, chances = _posteriors(model, values)
    ends = np.cumsum(lengths)
    answers = []
    for end, length in zip(ends.tolist(), lengths.tolist(), strict=True):
        if not length:
            answers.append((UNKNOWN, 0.0))
            continue
        mean = chances[end - length : end].mean(axis=0)
        best = int(mean.argmax())
        answers.append((model.labels[best], min(1.0, float(mean[best]))))
    return answers


def label_words(model, text):
    """(word, language) for the words of a text that hold a letter, long ones in pieces; the model's general output."""
    _, cores, coded, _, chances = _posteriors(model, [text])
    return [(cores[code], model.labels[best]) for code, best in zip(coded[0].tolist(), chances.argmax(axis=1).tolist(), strict=True)]


def third_of(doc_id):
    """The fold that is held out: crc32 of the id as text leaves 1 when divided by 3. A null id isn't held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs, held_out=None):
    return fit(train_rows(docs, third_of(F.col("doc_id")) if held_out is None else held_out))


def identify(docs, model=None):
    """doc_id, held_out, lang_pred, score per document, by a model trained on the other two folds.

    `und` with score 0 for null text, text without a letter, and when nothing could be learned. Ties go to the language that sorts
    first. Repeated rows get equal answers; null ids count as not held out but are hashed like any other; an empty table gives no rows.
    """
    held = third_of(F.col("doc_id"))
    model = model or train(docs, held)

    def run(batches):
        for batch in frames.bounded(batches, _slice(model)):
            values = frames.texts(batch.column(2))
            answers = predict_texts(model, values) if model else [(UNKNOWN, 0.0)] * len(values)
            yield frames.record(
                {
                    "doc_id": batch.column(0), "held_out": batch.column(1),
                    "lang_pred": pa.array([lang for lang, _ in answers], pa.string()),
                    "score": pa.array([score for _, score in answers], pa.float64()),
                }
            )

    schema = f"doc_id {frames.id_type(docs)}, held_out boolean, lang_pred string, score double"
    return frames.map_arrow(docs.select("doc_id", held.alias("held_out"), "text"), run, schema)


def keep_identified(docs, least=0.4):
    """The documents, all columns, whose language is known with a score of at least `least`."""
    model, place = train(docs), docs.columns.index("text")

    def run(batches):
        for batch in frames.bounded(batches, _slice(model)):
            values = frames.texts(batch.column(place))
            answers = predict_texts(model, values) if model else [(UNKNOWN, 0.0)] * len(values)
            yield batch.filter(pa.array([lang != UNKNOWN and score >= least for lang, score in answers], pa.bool_()))

    return frames.map_arrow(docs, run, docs.schema)
