"""Problem 9: the subject areas of each document.

Weighted subject terms are matched by a multi-pattern automaton; a sentence's evidence is the sum of its terms' weights,
which grow with a term's rarity and its purity, and a document's share of a subject is the number of its sentences on it
over the number of its sentences on any subject, so that length makes no difference. Every subject whose share reaches
the subject's threshold is assigned; thresholds are calibrated on labelled documents that no weight was fitted on.

The terms start from a short curated list and from the hand labels of all labelled documents, and are then
weighed over the whole corpus: words and phrases are counted by the subject of the sentences they stand in, in one
distributed pass for each round. Texts are handled in chunks, as arrays of word codes: matching, scoring and counting
are array operations.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.leakage import bare, words
from marketlens.session import broadcastable, spread, written

CURATED = {
    "software": "code software server database bug deployment login query compiler refactoring debugging programmer developer",
    "finance": "tax invoice credit loan dividend budget audit insurance accountant ledger treasury revenue bank",
    "law": "court legal lawyer attorney witness statute appeal lease plea affidavit arbitration liability injunction",
    "healthcare": "patient nurse surgery clinic wound dosage hospital symptoms physician medicine pharmacist dental ward",
    "sales": "sales discount buyer quota upselling dealer loyalty telecaller prospect territory retail customer pitching",
    "education": "school pupil lesson exam teacher lecture homework curriculum scholarship tutor coursework classroom",
    "logistics": "freight pallet warehouse parcel customs forklift consignment container truck courier dispatch fleet",
    "manufacturing": "factory lathe conveyor assembly machinist boiler foundry moulding fitter castings weld scrap",
    "hospitality": "hotel guest banquet kitchen chef menu housekeeper barista lobby catering tourist buffet",
    "construction": "concrete scaffold masonry crane rebar bricks plumbing surveying plaster excavation mason trench",
    "science": "laboratory experiment microscope enzyme hypothesis specimen physicist gene protein isotope chemist spectra",
    "sport": "athlete coach tournament referee stadium league swimming sprint fitness goalkeeper relay cycling",
    "media": "headline journalist editor podcast footage storyboard newsroom advertising reporter animation logo editorial",
    "agriculture": "crop livestock tractor harvest orchard irrigation soil poultry dairy fertiliser plough agronomist",
}
"""Curated words of each subject; further subjects of the table start from their own description and labels."""
CURATED_OTHER = {
    "software": "servidor codigo programa despliegue quellcode datenbank schnittstelle",
    "finance": "factura credito presupuesto banco rechnung kredit bilanz bankkonto",
    "law": "abogado tribunal clausula juez anwalt gericht klage vertrag",
    "healthcare": "paciente enfermera clinica receta klinik arzt pflege krankenhaus",
    "sales": "venta descuento cliente cuota verkauf rabatt handler kundenliste",
    "education": "alumno escuela examen aula schule schuler prufung unterricht",
    "logistics": "almacen aduana contenedor camion lager fracht zoll lieferwagen",
    "manufacturing": "fabrica torno soldadura montaje fabrik fließband drehbank werkzeug",
    "hospitality": "huesped cocina habitacion banquete gast kuche zimmer speisekarte",
    "construction": "hormigon grua andamio ladrillo beton kran gerust ziegel",
    "science": "laboratorio experimento muestra microscopio labor versuch probe mikroskop",
    "sport": "atleta entrenador torneo estadio sportler turnier stadion mannschaft",
    "media": "periodista redaccion titular camara redaktion schlagzeile kamera zeitung",
    "agriculture": "cosecha ganado semilla abono ernte vieh traktor saatgut",
}
"""The same in Spanish and German, without marks."""

HELD_OUT = 5
"""One in so many labelled documents is kept from the fit, for the calibration."""
ROUNDS = 2
"""Passes that weigh terms over the corpus."""
LONGEST = 3
"""Words of the longest term."""
LEAST_COUNT, LEAST_PURITY = 3, 0.6
LEAST_SUPPORT = 1e-5
"""A term stands in this share of all sentences with a subject, and in LEAST_COUNT. A sentence of w words has at most 3w phrases, so that there are at most 3w / LEAST_SUPPORT terms: some millions, at about 30 bytes each."""
MOST_NAMES = 10_000
"""More subjects than this are no list of subjects: an error."""
BLOCK_TERMS = 50_000
"""Terms of one automaton; a larger lexicon is matched block by block."""
CHUNK_CHARS = 4 << 20
"""Text that is handled at once."""
MAIN_SHARE = 0.6
LEAST_SHARE, LEAST_SENTENCES = 0.3, 2
"""Threshold without labels to calibrate it; sentences a subject needs unless the document is hardly longer."""
CALIBRATION = tuple(x / 100 for x in range(20, 41))
"""Thresholds to choose from."""
LEAST_OF_ALL = 0.2
"""A document with one sentence on a subject is about it if that is such a share of all its sentences; else it is in passing."""
PRIOR = 2.0
_BREAK = re.compile(r"[.?!:;\n\r]+|&bull;|</?(?:p|li|h3|br|ul)\s*/?>", re.IGNORECASE)
_TOKEN = re.compile(r"[^\W_]+|\n")


class Lexicon:
    """Terms with one subject and weight each, and the automata that find them.

    Terms are kept packed, in blocks of BLOCK_TERMS; the automaton of a block is built when it is its turn, and only a
    single one is kept.
    """

    def __init__(self, terms: Iterable[tuple[str, str, float]]) -> None:
        rows, names = iter(terms), {}
        self._blocks: list[tuple[str, array, array]] = []
        while part := list(islice(rows, BLOCK_TERMS)):
            numbers = array("H", [names.setdefault(subject, len(names)) for _, subject, _ in part])
            self._blocks.append(("\n".join(term for term, _, _ in part), numbers, array("d", [weight for _, _, weight in part])))
        self.names, self._kept = list(names), None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_kept": None}

    def __len__(self) -> int:
        return sum(len(weights) for _, _, weights in self._blocks)

    def __iter__(self) -> Iterator[tuple[str, str, float]]:
        for text, numbers, weights in self._blocks:
            yield from zip(text.split("\n"), (self.names[i] for i in numbers), weights, strict=True)

    def _automata(self) -> Iterator[tuple]:
        """For each block its automaton, and of each term length, words, subject and weight."""
        import ahocorasick

        for text, numbers, weights in self._blocks:
            found = self._kept
            if found is None:
                automaton, terms = ahocorasick.Automaton(ahocorasick.STORE_INTS), text.split("\n")
                for i, term in enumerate(terms):
                    automaton.add_word(f" {term} ", i)
                automaton.make_automaton()
                sizes = np.array([(len(t), t.count(" ") + 1) for t in terms], np.int64)
                found = automaton, sizes[:, 0], sizes[:, 1], np.array(numbers, np.int64), np.array(weights)
            if len(self._blocks) == 1:
                self._kept = found
            yield found

    def hits(self, text: str) -> tuple[np.ndarray, ...]:
        """Start, words, subject, weight and number of each term found in ``text``, in order; terms overlap only if none holds the other."""
        parts, before = [], 0
        for automaton, length, n, subject, weight in self._automata():
            found = np.fromiter(chain.from_iterable(automaton.iter(text)), np.int64).reshape(-1, 2)
            end, term = found[:, 0], found[:, 1]
            parts.append((end - length[term], end, n[term], subject[term], weight[term], term + before))
            before += len(length)
        if not parts:
            return (np.zeros(0, np.int64),) * 5
        start, end, n, subject, weight, term = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.lexsort((-end, start))
        start, end, n, subject, weight, term = (x[order] for x in (start, end, n, subject, weight, term))
        last = np.append(-1, np.maximum.accumulate(end)[:-1]) if len(end) else end
        keep = end > last
        return start[keep], n[keep], subject[keep], weight[keep], term[keep]


class Chunk:
    """Some texts as word codes, with the sentence and text each word stands in; list items, headings and paragraphs end sentences too."""

    def __init__(self, texts: list[str]) -> None:
        tokens, sizes = ["\n"], []  # the first token, and so code 0, is a break
        for text in texts:
            before = len(tokens)
            tokens += _TOKEN.findall(bare(_BREAK.sub("\n", text)))
            tokens.append("\n")
            sizes.append(len(tokens) - before)
        sizes[:1] = [x + 1 for x in sizes[:1]] or [1]
        coded = pa.array(tokens, pa.string()).dictionary_encode()
        self.words, self.text = coded.dictionary, f" {' '.join(tokens)} "
        self.ids = coded.indices.to_numpy().astype(np.int64)
        self.doc = np.repeat(np.arange(len(sizes)), sizes)
        ends = np.flatnonzero(self.ids == 0)
        self.sentence = np.searchsorted(ends, np.arange(len(tokens)))
        self.sentence_doc = self.doc[ends]
        self.rest = ends[self.sentence] - np.arange(len(tokens))
        lengths = pc.utf8_length(self.words).to_numpy().astype(np.int64)[self.ids]
        self.starts = np.cumsum(lengths + 1) - lengths

    def scored(self, lexicon: Lexicon) -> tuple[np.ndarray, ...]:
        """Of each sentence its best subject (-1 for none), whether it has over half the second's evidence again, and of the hits first word, words and number."""
        start, n, subject, weight, term = lexicon.hits(self.text)
        first = np.searchsorted(self.starts, start)
        names = np.argsort(np.argsort(lexicon.names)) if lexicon.names else np.zeros(0, np.int64)
        width = max(1, len(names))
        pair, at = np.unique(self.sentence[first] * width + subject, return_inverse=True)
        score = np.bincount(at, weights=weight, minlength=len(pair))
        sentence, who = pair // width, pair % width
        order = np.lexsort((names[who] if len(who) else who, -np.round(score, 9), sentence))
        sentence, who, score = sentence[order], who[order], score[order]
        lead = np.append(True, np.diff(sentence) != 0)[: len(sentence)]
        best, clear = np.full(len(self.sentence_doc), -1), np.ones(len(self.sentence_doc), bool)
        best[sentence[lead]] = who[lead]
        second = np.flatnonzero(~lead)
        second = second[lead[second - 1]]
        clear[sentence[second]] = 2 * score[second] <= score[second - 1]
        return best, clear, first, n, term

    def phrases(self, unit: np.ndarray, subject: np.ndarray, inner: np.ndarray | None = None, inside: np.ndarray | None = None) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Phrases of up to LONGEST words, by subject: the number of units (of words, as by ``unit``) that hold them.

        ``subject``: of each word; -1 doesn't count. Phrases that end within ``inside`` words of their first take the subject ``inner``.
        """
        size = np.int64(len(self.words) + 1)
        keys, places, whose = [], [], []
        key = np.zeros(len(self.ids), np.int64)
        for n in range(1, LONGEST + 1):
            key = key * size + 1 + np.append(self.ids[n - 1 :], np.zeros(min(n - 1, len(self.ids)), np.int64))
            at = np.flatnonzero(self.rest >= n)
            mine = subject[at] if inner is None else np.where(inside[at] >= n, inner[at], subject[at])
            at, mine = at[mine >= 0], mine[mine >= 0]
            keys.append(key[at])
            places.append(at << 2 | n)
            whose.append(mine)
        key, place, mine = np.concatenate(keys), np.concatenate(places), np.concatenate(whose)
        order = np.argsort(key, kind="stable")
        key, place, mine = key[order], place[order], mine[order]
        new = np.append(True, np.diff(key) != 0)[: len(key)]
        once = new | np.append(True, np.diff(unit[place >> 2]) != 0)[: len(key)]
        width = int(mine.max(initial=0)) + 1
        pair, at, n = np.unique(((np.cumsum(new) - 1) * width + mine)[once], return_index=True, return_counts=True)
        place = place[once][at]
        names, at, longest = self.words, place >> 2, place & 3
        parts = [names.take(pa.array(self.ids[at]))]
        for k in range(1, LONGEST):
            more = names.take(pa.array(self.ids[np.minimum(at + k, len(self.ids) - 1)], mask=longest <= k))
            parts.append(more)
        return pc.binary_join_element_wise(*parts, " ", null_handling="skip"), pair % width, n


def chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list[tuple], Chunk]]:
    """The rows of the batches, whose last column is a text, in chunks of CHUNK_CHARS, or one text."""
    rows, size = [], 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            rows.append(row)
            size += len(row[-1])
            if size >= CHUNK_CHARS:
                yield rows, Chunk([r[-1] for r in rows])
                rows, size = [], 0
    if rows:
        yield rows, Chunk([r[-1] for r in rows])


def _counts(phrases: pa.Array, subject: np.ndarray, n: np.ndarray, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([phrases, pa.array(names, pa.string()).take(pa.array(subject)), pa.array(n)], ["phrase", "subject", "n"])


_COUNTED = "phrase string, subject string, n bigint"


def _summed(counts: DataFrame) -> DataFrame:
    return counts.groupBy("phrase", "subject").agg(F.sum("n").alias("n"))


def labelled_counts(labelled: DataFrame) -> DataFrame:
    """``phrase, subject, n``: labelled documents (``subject, text``) that hold the phrase."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, chunk in chunks(batches):
            names = {s: i for i, s in enumerate(dict.fromkeys(r[0] for r in rows))}
            of_doc = np.array([names[r[0]] for r in rows], np.int64)
            yield _counts(*chunk.phrases(chunk.doc, of_doc[chunk.doc]), list(names))

    return _summed(spread(labelled.select("subject", "text")).mapInArrow(count, _COUNTED))


def phrase_counts(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``phrase, subject, n``: sentences of the corpus that hold the phrase, by the subject of most evidence in them.

    A sentence without terms, or the part of one whose only term would confirm itself, counts for the main subject of its
    document, if most of the document is on it; wording that goes with any subject thus becomes impure.
    """
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)  # packed; see LEAST_SUPPORT for its bound

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = shared.value.names
        for rows, chunk in chunks(batches):
            best, _, first, n, term = chunk.scored(shared.value)
            main = np.full(len(rows), -1)
            known = best >= 0
            pair, times = np.unique(chunk.sentence_doc[known] * (len(names) + 1) + best[known], return_counts=True)
            doc, who = pair // (len(names) + 1), pair % (len(names) + 1)
            order = np.lexsort((who, -times, doc))
            lead = order[np.append(True, np.diff(doc[order]) != 0)[: len(order)]]
            total = np.bincount(doc, weights=times, minlength=len(rows))
            lead = lead[times[lead] >= MAIN_SHARE * total[doc[lead]]]
            main[doc[lead]] = who[lead]
            # sentences with one term, however often: the term itself says nothing new
            pair = np.unique(np.stack([chunk.sentence[first], term]), axis=1)[0] if len(first) else first
            alone = np.bincount(pair, minlength=len(best)) == 1
            inside = np.zeros(len(chunk.ids), np.int64)
            for k in range(int(n.max(initial=0))):
                np.maximum.at(inside, first[n > k] + k, n[n > k] - k)
            inside[~alone[chunk.sentence]] = 0
            of_sentence = np.where(best >= 0, best, main[chunk.sentence_doc])
            yield _counts(*chunk.phrases(chunk.sentence, of_sentence[chunk.sentence], main[chunk.doc], inside), names)

    return _summed(spread(docs.select("text").where("text IS NOT NULL")).mapInArrow(count, _COUNTED))


def weighed(counts: DataFrame, support: float = 0.0) -> tuple[DataFrame, set[str]]:
    """``phrase, subject, weight`` of the phrases that stand for one subject, and the subjects that have any.

    A phrase is seen LEAST_COUNT times, and in a share ``support`` of all; mostly with its subject (LEAST_PURITY, with a
    prior by the subject's size); and weighed by purity and rarity.
    """
    per = counts.groupBy("phrase").agg(F.sum("n").alias("total"), F.max(F.struct("n", "subject")).alias("top"))
    good = per.where((F.col("total") >= LEAST_COUNT) & (F.col("top.n") >= LEAST_PURITY * F.col("total")))
    good = written(good.select("phrase", "top.subject", "top.n", "total"), "terms")
    most = {r["subject"]: r["n"] for r in good.groupBy("subject").agg(F.sum("n").alias("n")).collect()}  # one row a subject
    size = sum(most.values()) or 1
    prior = counts.sparkSession.createDataFrame([(s, n / size) for s, n in most.items()], "subject string, prior double")
    purity = (F.col("n") + PRIOR * F.col("prior")) / (F.col("total") + PRIOR)
    kept = good.where(F.col("total") >= support * size / (3 * LONGEST)).join(F.broadcast(prior), "subject").withColumn("share", purity).where(F.col("share") >= LEAST_PURITY)
    return kept.select("phrase", "subject", (F.col("share") * F.log1p(F.lit(size) / F.col("total"))).alias("weight")), set(most)


def first_lexicon(labelled: DataFrame, subjects: dict[str, str]) -> Lexicon:
    """Terms of the curated list, and of labelled documents by the purity of their labels."""
    rows, _ = weighed(labelled_counts(labelled))
    curated = {w: (s, 1.0 + float(np.log1p(len(subjects)))) for s in subjects for w in (f"{CURATED.get(s, '')} {CURATED_OTHER.get(s, '')}".strip() or " ".join(words(subjects[s]))).split()}

    def terms() -> Iterator[tuple[str, str, float]]:
        for r in rows.toLocalIterator():  # terms of the labelled documents
            curated.pop(r["phrase"], None)
            yield tuple(r)
        yield from ((term, *what) for term, what in curated.items())

    return Lexicon(terms())


def corpus_lexicon(docs: DataFrame, lexicon: Lexicon) -> Lexicon:
    """All terms weighed anew over all sentences of the corpus; the terms of a subject that has none there stay."""
    rows, known = weighed(phrase_counts(docs, lexicon), LEAST_SUPPORT)
    unseen = {term: (subject, weight) for term, subject, weight in lexicon if subject not in known}

    def terms() -> Iterator[tuple[str, str, float]]:
        for r in rows.toLocalIterator():
            unseen.pop(r["phrase"], None)
            yield tuple(r)
        yield from ((term, *what) for term, what in unseen.items())

    return Lexicon(terms())


def document_shares(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``doc_id, subject, sentences, share, of_all``: for each subject of a document its sentences, their share of all that have a subject, and the sentences of the document.

    A sentence in which the second subject has over half as much evidence as the first has none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array(shared.value.names, pa.string())
        for rows, chunk in chunks(batches):
            best, clear, *_ = chunk.scored(shared.value)
            known = (best >= 0) & clear
            pair, n = np.unique(chunk.sentence_doc[known] * (len(names) + 1) + best[known], return_counts=True)
            doc, who = pair // (len(names) + 1), pair % (len(names) + 1)
            total = np.bincount(doc, weights=n, minlength=len(rows))
            ids = pa.array([r[0] for r in rows], pa.int64())
            filled = np.unique(chunk.sentence[chunk.ids != 0])
            of_all = np.bincount(chunk.sentence_doc[filled], minlength=len(rows))
            columns = [ids.take(pa.array(doc)), names.take(pa.array(who)), pa.array(n), pa.array(n / total[doc]), pa.array(of_all[doc])]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "subject", "sentences", "share", "of_all"])

    return spread(docs.select("doc_id", "text").where("doc_id IS NOT NULL AND text IS NOT NULL")).mapInArrow(share, "doc_id bigint, subject string, sentences bigint, share double, of_all bigint")


def labelled_documents(labels: DataFrame, subjects: Iterable[str]) -> DataFrame:
    """``doc_id, subject, held_out``: all labelled documents, those held out by hash; of disagreeing labellers the majority, a tie says nothing."""
    named = labels.select("doc_id", F.lower(F.trim("subject")).alias("subject")).where(F.col("subject").isin(*subjects) & F.col("doc_id").isNotNull())
    votes = named.groupBy("doc_id", "subject").agg(F.count(F.lit(1)).alias("n")).groupBy("doc_id").agg(F.max("n").alias("m"), F.collect_list(F.struct("subject", "n")).alias("v"))
    clear = votes.select("doc_id", F.filter("v", lambda x: x["n"] == F.col("m")).alias("v")).where("size(v) = 1").select("doc_id", F.col("v")[0]["subject"].alias("subject"))
    return clear.withColumn("held_out", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(HELD_OUT)) == 0)


def fit(docs: DataFrame, sample: DataFrame, described: dict[str, str], rounds: int = ROUNDS) -> Lexicon:
    """The lexicon of a corpus, from the curated list, the labelled documents (without what is held out) and all its sentences."""
    fitted = sample.where("NOT held_out").select("doc_id", "subject")
    labelled = docs.select("doc_id", "text").where("text IS NOT NULL").join(broadcastable(fitted), "doc_id")
    lexicon = first_lexicon(labelled, described)
    for _ in range(rounds):
        lexicon = corpus_lexicon(docs, lexicon)
    return lexicon


def thresholds(shares: DataFrame, held_out: DataFrame, labels: DataFrame, grid: tuple[float, ...] = CALIBRATION) -> DataFrame:
    """``subject, threshold``: of the grid, that which agrees with most held-out labels.

    Of documents ``held_out`` (``doc_id``), a subject is right where any labeller named it. Labels near a threshold are few: those of all
    subjects together count as one subject more, and of equal thresholds the nearest to LEAST_SHARE is taken. Subjects
    without held-out documents have no row.
    """
    named = labels.select("doc_id", F.lower(F.trim("subject")).alias("subject")).distinct().withColumn("named", F.lit(True))
    held = shares.join(broadcastable(held_out.select("doc_id").distinct()), "doc_id").where(F.col("sentences") >= LEAST_SENTENCES)
    judged = held.join(named, ["doc_id", "subject"], "left").select("subject", "share", F.coalesce("named", F.lit(False)).alias("named"))
    right = judged.withColumn("t", F.explode(F.array(*map(F.lit, grid)))).groupBy("subject", "t").agg(F.count_if((F.col("share") >= F.col("t")) == F.col("named")).alias("n"))
    pooled = right.groupBy("t").agg(F.sum("n").alias("all_n"), F.count(F.lit(1)).alias("k"))  # one row a threshold
    scored = right.join(F.broadcast(pooled), "t").withColumn("score", F.col("n") + F.col("all_n") / F.col("k"))
    order = Window.partitionBy("subject").orderBy(F.desc("score"), F.abs(F.col("t") - LEAST_SHARE), "t")
    return scored.withColumn("_r", F.row_number().over(order)).where("_r = 1").select("subject", F.col("t").alias("threshold"))


def _passing(shares: DataFrame, least: Column) -> DataFrame:
    return shares.where((F.col("share") >= least) & ((F.col("sentences") >= LEAST_SENTENCES) | ((F.col("share") == 1) & (F.col("sentences") >= LEAST_OF_ALL * F.col("of_all")))))


def _fitted_shares(docs: DataFrame, labels: DataFrame, subjects: DataFrame, **kw: object) -> tuple[DataFrame, DataFrame]:
    named = subjects.where("subject IS NOT NULL").limit(MOST_NAMES + 1).collect()
    if len(named) > MOST_NAMES:
        raise ValueError("more subjects than a list of subjects holds")
    described = {r["subject"].strip().lower(): r["description"] or "" for r in named}
    sample = written(labelled_documents(labels, described), "labelled")
    shares = document_shares(docs, fit(docs, sample, described, **kw))
    once = shares.groupBy("doc_id", "subject").agg(F.max("sentences").alias("sentences"), F.max("share").alias("share"), F.max("of_all").alias("of_all"))
    return written(once, "shares"), sample


def document_subjects(docs: DataFrame, labels: DataFrame, subjects: DataFrame, most: int | None = None, **kw: object) -> DataFrame:
    """``doc_id, subject, sentences, share``: the subjects of each document, the ``most`` first or all.

    A subject needs its threshold of the sentences that have a subject (see ``thresholds``; LEAST_SHARE without
    labels), and LEAST_SENTENCES of them unless it is the only one in a short document. ``most`` takes those of the highest shares, ties in
    alphabetical order. Documents with a null or empty text, or without any subject matter, have no row; of repeated
    rows of a document the one with most sentences on the subject counts. Without labels the curated list has to do.
    """
    shares, sample = _fitted_shares(docs, labels, subjects, **kw)
    limits = F.broadcast(thresholds(shares, sample.where("held_out"), labels))  # one row a subject
    passing = _passing(shares.join(limits, "subject", "left"), F.coalesce("threshold", F.lit(LEAST_SHARE))).select("doc_id", "subject", "sentences", "share")
    if most is None:
        return passing
    order = Window.partitionBy("doc_id").orderBy(F.desc("share"), "subject")
    return passing.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= most).drop("_r")


def held_out_agreement(docs: DataFrame, labels: DataFrame, subjects: DataFrame, **kw: object) -> DataFrame:
    """``subject, n_labels, n_assigned``: of labels that nothing was fitted on, how many name an assigned subject, at the LEAST_SHARE that no label has set."""
    shares, sample = _fitted_shares(docs, labels, subjects, **kw)
    passing = _passing(shares, F.lit(LEAST_SHARE)).select("doc_id", "subject", F.lit(1).alias("hit"))
    held = sample.where("held_out").join(passing, ["doc_id", "subject"], "left")
    return held.groupBy("subject").agg(F.count(F.lit(1)).alias("n_labels"), F.count("hit").alias("n_assigned"))
