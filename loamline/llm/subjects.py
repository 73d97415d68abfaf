"""Subject areas of documents: labelling functions on sentences, joined by a latent model that learns their accuracies."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loamline.llm.leakage import Items, rolling
from loamline.session import cut_lineage

# Bounds of the labelled sample that the word model is fitted on: documents, their characters, and those of one document.
MAX_LABELLED, MAX_LABELLED_CHARS, MAX_LABELLED_TEXT = 10_000, 40_000_000, 200_000
PASSAGE_RUN = 4  # successive words that a passage of a held-out item shares with it

# Words that speak of a subject, in the languages of the collection; a weak labelling function of its own.
LEXICON = {
    "crop_science": "crop crops seed seeds seedling breeding cultivar cultivars variety varieties germination maize sorghum millet wheat cassava bean beans cowpea pigeonpea striga rust "
    "blight genotype genotypes landrace panicles tiller canopy pollination trial semence semences variété maïs sorgho manioc rouille germination pollinisation récolte semente sementes "
    "milho mandioca feijão ferrugem polinização germinação mbegu mahindi mtama muhogo kutu mazao",
    "soil_and_climate": "soil soils rain rains rainfall climate drought flood erosion moisture nitrogen carbon groundwater evapotranspiration weather mulch terraced acidity sol sols pluie "
    "pluies climat érosion sécheresse nappe carbone acidité températures solo solos chuva chuvas clima erosão seca carbono acidez udongo mvua hali ukame mmomonyoko kaboni tindikali",
    "trade_and_markets": "market markets trade price prices tariff tariffs customs export import auction freight wholesale retail border shipments consignments millers futures marché marchés "
    "prix commerce douane douanière exportation importation enchères commerçants mercado mercados preço preços comércio alfândega aduaneira exportação leilão soko masoko bei biashara forodha "
    "mnada",
    "food_nutrition": "nutrition diet diets dietary anaemia stunting wasting vitamin protein calorie breastfeeding porridge micronutrient iron weaning intake meal meals nutrition régime anémie "
    "alimentaire vitamine allaitement calorique croissance carence nutrição dieta anemia vitamina aleitamento calorias desnutrição ferro lishe mlo upungufu vitamini unyonyeshaji udumavu",
    "policy_and_law": "law laws court courts bill act statute regulation regulator tribunal licence licensing clause petition gazette parliamentary by-laws ministry decree loi lois tribunal "
    "décret règlement cour appel sanctions foncier lei leis tribunal decreto regulamento sanções sheria mahakama kanuni bunge rufaa mswada",
    "humanitarian": "refugee refugees displaced displacement relief emergency famine convoy camp shelter rations aid cholera evacuation humanitarian réfugiés déplacées secours urgence famine "
    "convoi camp abri refugiados deslocadas ajuda emergência fome comboio abrigos wakimbizi zilizohamishwa msaada dharura njaa kambi",
    "farm_software": "software code database server servers app API firmware sensor sensors login interface backup dashboard data query latency automated encryption logiciel serveur base données "
    "application capteur micrologiciel sauvegarde código servidor aplicativo sensor interface cópia programu mfumo data kiolesura seva nakala",
    "livestock_health": "livestock cattle goat goats sheep poultry herd heifers dairy veterinary vaccine vaccination brucella mastitis tick ticks calf grazing kraal bétail chèvres chevreaux "
    "vétérinaire vaccin mammite tiques troupeau transhumance volaille gado cabras cabritos veterinário vacina mastite carraças rebanho mifugo ng'ombe mbuzi chanjo kupe kiwele",
    "finance_and_enterprise": "bank credit loan loans savings insurance equity venture funding investor shareholders payroll audit profit bond mobile money banque crédit prêt prêts épargne "
    "assurance microcrédit investisseurs fonds banco crédito empréstimo poupança seguro microcrédito investidores capital benki mkopo mikopo akiba bima hisa wawekezaji",
    "sport_and_community": "football netball volleyball league cup goal goalkeeper coach referee referees tournament match fans marathon wrestling penalty shoot-out équipe ligue coupe but gardien "
    "entraîneur lutte course supporters liga futebol taça golo guarda-redes treinador corrida adeptos mpira ligi kombe bao mlinda kocha mbio mashabiki timu",
}
_ABBREVIATION = re.compile(r"(?:\b(?:Dr|Mr|Mrs|Ms|Prof|St|No|Nos|Fig|Figs|Tab|Eq|vs|cf|approx|ca|pers|comm|al|etc|e\.g|i\.e|p|pp|vol|ed|Sr|Sra|Mme|env|p\.ex)|\b[A-Z])\.$")
_STOP = re.compile(r"[.!?…][\"”’'»)\]]*\s+|\n\s*\n\s*")
_WORD = re.compile(r"[^\W_]+")
_BLANK_LINE = re.compile(r"\n[ \t\r]*\n")


def sentences(text: str) -> list[tuple[int, str]]:
    """``(paragraph, sentence)`` of a text: ends are marks followed by space, but not those of abbreviations; blank lines end
    paragraphs, single line feeds nothing."""
    out, begin, paragraph = [], 0, 0
    for m in _STOP.finditer(text):
        if text[m.start()] not in "\n" and _ABBREVIATION.search(text[max(begin, m.start() - 9) : m.start() + 1]):
            continue
        part = text[begin : m.end()].strip()
        if part:
            out.append((paragraph, part))
        begin = m.end()
        if _BLANK_LINE.search(m.group()):
            paragraph += 1
    part = text[begin:].strip()
    if part:
        out.append((paragraph, part))
    return out


class Passages:
    """Finds the sentences that belong to passages of held-out items."""

    def __init__(self, items: list[tuple[int, str]]) -> None:
        index = Items(items, PASSAGE_RUN)
        self.number, self.known = index.number, frozenset(index.known.tolist())

    def of(self, parts: list[list[str]]) -> np.ndarray:
        """For each sentence as words, whether at least half of them stand in runs shared with an item."""
        lengths = np.array([len(t) for t in parts], dtype=np.int64)
        get = self.number.get
        numbers = np.array([get(w, 0) for t in parts for w in t], dtype=np.int64)
        if len(numbers) < PASSAGE_RUN or not self.known:
            return np.zeros(len(parts), dtype=bool)
        known = np.concatenate([[0], np.cumsum(numbers > 0)])
        places = np.flatnonzero(known[PASSAGE_RUN:] - known[:-PASSAGE_RUN] == PASSAGE_RUN)
        marked = np.zeros(len(numbers) + 1)
        values = rolling(numbers, PASSAGE_RUN)[places].tolist()
        for at, value in zip(places.tolist(), values):
            if value in self.known:
                marked[at : at + PASSAGE_RUN] = 1
        ends = np.cumsum(lengths)
        total = np.concatenate([[0], np.cumsum(marked[:-1])])
        return ((total[ends] - total[ends - lengths]) >= 0.5 * lengths) & (lengths > 0)


def _places(document: np.ndarray, paragraph: np.ndarray) -> np.ndarray:
    """A number for each paragraph of each document."""
    return np.unique(document * (paragraph.max(initial=0) + 1) + paragraph, return_inverse=True)[1]


class WordModel:
    """How strongly each word speaks for each subject: log-odds against the subject's share, learned from labelled documents."""

    def __init__(self, subjects: list[str]) -> None:
        self.subjects = subjects
        self.rows: dict[str, int] = {}
        self.odds = np.zeros((1, len(subjects)), dtype=np.float32)

    def fit(self, texts: list[str], labels: list[list[int]], passages: Passages, rounds: int = 3, shrink: float = 0.5, least_documents: int = 2) -> WordModel:
        """Sentences get soft subjects within their document's labels and near those of their paragraph, words get odds from
        those sentences, and again; wrong labels yield to the words. Sentences of held-out passages teach nothing. A word of
        fewer than ``least_documents`` documents teaches nothing either, however many are labelled."""
        k = len(self.subjects)
        lexicon = {w: i for i, s in enumerate(self.subjects) for w in LEXICON.get(s, "").lower().split()}
        number: dict[str, int] = {}
        for w in lexicon:
            number.setdefault(w, len(number))
        cells, owner, doc_of, para_of = array("i"), array("i"), array("i"), array("i")
        for at in range(0, len(texts), 500):
            parts, document, paragraph = split_documents(texts[at : at + 500])
            skip = passages.of(parts)
            for words, d, p, aside in zip(parts, document, paragraph, skip):
                if aside:
                    continue
                ids = {number.setdefault(w, len(number)) for w in words if w and not w[0].isdigit()}
                cells.extend(ids)
                owner.extend([len(doc_of)] * len(ids))
                doc_of.append(at + d)
                para_of.append(p)
        cell, own, doc = np.array(cells, dtype=np.int64), np.array(owner, dtype=np.int64), np.array(doc_of, dtype=np.int64)
        in_docs = np.bincount(np.unique(cell * (len(texts) + 1) + doc[own]) // (len(texts) + 1), minlength=len(number)) if len(cell) else np.zeros(len(number))
        place = _places(doc, np.array(para_of, dtype=np.int64))
        size = np.bincount(place) if len(place) else np.zeros(0)
        prior = np.full((max(1, len(texts)), k), 0.1 / k)
        for d, mine in enumerate(labels):
            for s in mine:
                prior[d, s] += 0.9 / len(mine)
        seed = np.zeros((len(number), k))
        for w, s in lexicon.items():
            seed[number[w], s] = 3.0
        soft, odds = prior[doc], np.zeros((len(number), k))
        for _ in range(rounds):
            share = soft.sum(axis=0) + 1.0
            share /= share.sum()
            count = seed.copy()
            for s in range(k):
                count[:, s] += np.bincount(cell, weights=soft[own, s], minlength=len(number))
            odds = np.log((count + shrink * share) / (count.sum(axis=1, keepdims=True) + shrink) / share)
            score = np.log(prior)[doc]
            for s in range(k):
                near = np.bincount(place, weights=soft[:, s], minlength=len(size))
                score[:, s] += np.bincount(own, weights=odds[cell, s], minlength=len(doc)) + np.log((near[place] + 0.05) / (size[place] + 0.05 * k))
            soft = np.exp(score - score.max(axis=1, keepdims=True))
            soft /= soft.sum(axis=1, keepdims=True)
        keep = (np.abs(odds).max(axis=1) > 0.4) & ((in_docs >= least_documents) | (seed.max(axis=1) > 0))
        self.rows, rows = {}, [np.zeros(k)]
        for w, i in number.items():
            if keep[i]:
                self.rows[w] = len(rows)
                rows.append(odds[i])
        self.odds = np.array(rows, dtype=np.float32)
        return self

    def scores(self, parts: list[list[str]]) -> np.ndarray:
        """Summed log-odds of each sentence's words."""
        lengths = np.array([len(p) for p in parts], dtype=np.int64)
        get = self.rows.get
        cell = np.array([get(w, 0) for p in parts for w in p], dtype=np.int64)
        total = np.vstack([np.zeros((1, self.odds.shape[1])), np.cumsum(self.odds[cell], axis=0, dtype=np.float64)])
        ends = np.cumsum(lengths)
        return total[ends] - total[ends - lengths]


def split_documents(texts: list[str]) -> tuple[list[list[str]], list[int], list[int]]:
    """Sentences of many documents as words, with the document and paragraph of each; sentences without words are left out.
    Between documents stands an empty word that no model knows, so that nothing runs over."""
    parts, document, paragraph = [], [], []
    find = _WORD.findall
    for d, text in enumerate(texts):
        for p, sentence in sentences(text):
            found = find(sentence.lower())
            if found:
                parts.append(found)
                document.append(d)
                paragraph.append(p)
        if parts:
            parts[-1].append("")
    return parts, document, paragraph


# ---------------------------------------------------------------- labelling functions and their latent model
# The functions, in the order of a pattern's digits: fixed lexicon; learned words with a wide margin; with a narrow one; the
# rest of the paragraph; the publisher's address; the source. Digit 0 is silence, s + 1 a vote for subject s.
FUNCTIONS = ("lexicon", "words_sure", "words_unsure", "section", "address", "source")
SURE, UNSURE = 4.0, 1.0  # margins between the best and the next subject, as log-odds
USUAL_SHARE, USUAL_LABELS = 0.6, 20  # when an address or source has a usual subject


def vote(model: WordModel, lexicon: WordModel, parts: list[list[str]], document: list[int], paragraph: list[int], address: list[int], source: list[int]) -> np.ndarray:
    """Votes of all functions on all sentences, one column each."""
    n, k = len(parts), len(model.subjects)
    votes = np.zeros((n, len(FUNCTIONS)), dtype=np.int64)
    if not n:
        return votes

    def best(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        top = scores.argmax(axis=1)
        two = np.partition(scores, k - 2, axis=1) if k > 1 else np.hstack([np.zeros((n, 1)), scores])
        return top + 1, two[:, -1] - two[:, -2]

    top, margin = best(lexicon.scores(parts))
    votes[:, 0] = np.where(margin > 0.5, top, 0)
    top, margin = best(model.scores(parts))
    votes[:, 1] = np.where(margin >= SURE, top, 0)
    votes[:, 2] = np.where((margin >= UNSURE) & (margin < SURE), top, 0)
    place = _places(np.array(document, dtype=np.int64), np.array(paragraph, dtype=np.int64))
    sums = np.zeros((place.max() + 1, k + 1))
    np.add.at(sums, (place, votes[:, 1]), 1)
    others = sums[place]
    others[np.arange(n), votes[:, 1]] -= 1
    others[:, 0] = 0
    most = others.argmax(axis=1)
    clear = others.max(axis=1) > 0.5 * others.sum(axis=1)
    votes[:, 3] = np.where(clear & (others.max(axis=1) > 0), most, 0)
    d = np.array(document, dtype=np.int64)
    votes[:, 4], votes[:, 5] = np.array(address, dtype=np.int64)[d], np.array(source, dtype=np.int64)[d]
    return votes


class Agreement:
    """Latent true subjects behind the functions' votes: their accuracies and the subjects' shares by expectation and
    maximisation over the counts of vote patterns, without any label."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.accuracy = np.full(len(FUNCTIONS), 0.7)
        self.share = np.full(k, 1.0 / k)

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Probability of each subject for each row of votes; the share where all are silent."""
        score = np.tile(np.log(self.share), (len(patterns), 1))
        for j, a in enumerate(self.accuracy):
            said = np.flatnonzero(patterns[:, j])
            wrong = np.log((1 - a) / max(1, self.k - 1))
            score[said] += wrong
            score[said, patterns[said, j] - 1] += np.log(a) - wrong
        soft = np.exp(score - score.max(axis=1, keepdims=True))
        return soft / soft.sum(axis=1, keepdims=True)

    def fit(self, patterns: np.ndarray, counts: np.ndarray, rounds: int = 60) -> Agreement:
        for _ in range(rounds):
            soft = self.posterior(patterns) * counts[:, None]
            self.share = (soft.sum(axis=0) + 1.0) / (soft.sum() + self.k)
            for j in range(len(FUNCTIONS)):
                said = np.flatnonzero(patterns[:, j])
                right = soft[said, patterns[said, j] - 1].sum()
                self.accuracy[j] = np.clip((right + 1.4) / (counts[said].sum() + 2.0), 1.0 / self.k, 0.995)
        return self


def _pattern_batches(model: WordModel, lexicon: WordModel, passages: Passages, usual: dict[str, dict[str, int]]):  # noqa: ANN202
    k = len(model.subjects) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                ids, texts, address, source = (batch.column(i).to_pylist() for i in range(4))
                parts, document, paragraph = split_documents(texts)
                votes = vote(
                    model, lexicon, parts, document, paragraph,
                    [usual["address"].get(x, 0) for x in address], [usual["source"].get(x, 0) for x in source],
                )
                own = np.flatnonzero(~passages.of(parts)) if parts else np.zeros(0, dtype=np.int64)
                code = np.zeros(len(own), dtype=np.int64)
                for j in range(len(FUNCTIONS)):
                    code = code * k + votes[own, j]
                seen, code = np.unique(code, return_inverse=True)  # patterns of this batch: documents and patterns fit one integer
                keys, counts = np.unique(np.array(document, dtype=np.int64)[own] * max(1, len(seen)) + code, return_counts=True)
                yield pa.record_batch(
                    [pa.array(np.array(ids, dtype=np.int64)[keys // max(1, len(seen))]), pa.array(seen[keys % max(1, len(seen))]), pa.array(counts.astype(np.int64))],
                    names=["_doc", "pattern", "n"],
                )

    return run


def _usual(labelled: DataFrame, column: str, index: dict[str, int]) -> dict[str, int]:
    """The subject (+ 1) that most labels of an address or source name, where there is one. Each has USUAL_LABELS of the sample's
    labels, so that there are at most MAX_LABELLED x subjects / USUAL_LABELS of them."""
    counted = labelled.where(F.col(column).isNotNull()).groupBy(column, "subject").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(column)
    best = counted.withColumn("all", F.sum("n").over(w)).where((F.col("n") >= USUAL_SHARE * F.col("all")) & (F.col("all") >= USUAL_LABELS))
    return {r[column]: index[r["subject"]] + 1 for r in best.collect() if r["subject"] in index}


def subject_shares(
    documents: DataFrame, doc_id: str, text: str, subjects: list[str], labels: DataFrame, held_out: list[tuple[int, str]], *, address: str, source: str
) -> DataFrame:
    """``(doc_id, subject, sentences, share)``: the subjects that a document's sentences deal with, and their share of them.

    Every sentence is voted on by the labelling functions; their accuracies are learned from the votes' agreement alone, and
    a sentence deals with the subject whose posterior is above one half. Sentences of passages of ``held_out`` items count
    neither for a subject nor among the sentences.

    labels: ``(doc_id, subject)``, some of them wrong; they only teach the words, on a sample of at most MAX_LABELLED
    documents of about MAX_LABELLED_CHARS characters, none longer than MAX_LABELLED_TEXT, drawn by a hash. Without labels the fixed lexicon remains. Null ids or texts and documents without a word give
    no rows; null addresses and sources are silent; repeated rows of a document count together; empty tables give no rows;
    other columns are ignored, whatever their names.

    Plan: one narrow pass turns each document into counts of vote patterns (checkpointed, a few rows each); patterns, at most
    (subjects + 1) ** 6 and in fact a few hundred, are counted over all documents for the latent model.
    """
    index = {s: i for i, s in enumerate(subjects)}
    k = len(subjects)
    rows = documents.select(
        F.col(doc_id).cast("long").alias("_doc"), F.col(text).alias("_text"), F.col(address).cast("string").alias("address"), F.col(source).cast("string").alias("source")
    ).where(F.col("_doc").isNotNull() & F.col("_text").isNotNull())
    named = labels.select(F.col(doc_id).cast("long").alias("_doc"), "subject").where(F.col("_doc").isNotNull() & F.col("subject").isin(subjects)).distinct()
    said = named.groupBy("_doc").agg(F.sort_array(F.collect_set("subject")).alias("said"))
    lengths = rows.select("_doc", F.char_length("_text").alias("n")).where(F.col("n") <= MAX_LABELLED_TEXT)
    said = cut_lineage(said.join(lengths.groupBy("_doc").agg(F.max("n").alias("n")), "_doc"))  # labels of documents that are there
    size = said.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("chars")).first()
    drawn_share = min(1.0, 0.95 * MAX_LABELLED / max(1, size["docs"]), 0.9 * MAX_LABELLED_CHARS / max(1, size["chars"] or 0))  # by hash: a retry draws the same documents
    by_hash = F.pmod(F.xxhash64("_doc", F.lit(11)), F.lit(1_000_003)) < drawn_share * 1_000_003
    sample = cut_lineage(said.where(by_hash).select("_doc", "said").limit(MAX_LABELLED))
    drawn = rows.join(F.broadcast(sample), "_doc").dropDuplicates(["_doc"]).select("_doc", "_text", "said").toPandas().sort_values("_doc")
    passages = Passages(held_out)
    model = WordModel(subjects).fit(drawn["_text"].tolist(), [[index[s] for s in x] for x in drawn["said"]], passages)
    lexicon = WordModel(subjects).fit([], [], passages)
    labelled = rows.select("_doc", "address", "source").join(F.broadcast(sample.select("_doc", F.explode("said").alias("subject"))), "_doc")
    usual = {"address": _usual(labelled, "address", index), "source": _usual(labelled, "source", index)}

    patterns = cut_lineage(rows.mapInArrow(_pattern_batches(model, lexicon, passages, usual), "_doc long, pattern long, n long"))
    counted = patterns.groupBy("pattern").agg(F.sum("n").alias("n")).toPandas()
    code = counted["pattern"].to_numpy(dtype=np.int64)
    votes = np.stack([(code // (k + 1) ** (len(FUNCTIONS) - 1 - j)) % (k + 1) for j in range(len(FUNCTIONS))], axis=1) if len(code) else np.zeros((0, len(FUNCTIONS)), dtype=np.int64)
    soft = Agreement(k).fit(votes, counted["n"].to_numpy(dtype=float)).posterior(votes) if len(code) else np.zeros((0, k))
    decided = [(int(c), subjects[int(p.argmax())]) for c, p, v in zip(code, soft, votes) if p.max() > 0.5 and v.any()]
    spark = documents.sparkSession
    table = F.broadcast(spark.createDataFrame(decided, "pattern long, subject string"))
    said = patterns.join(table, "pattern", "left").groupBy("_doc", "subject").agg(F.sum("n").alias("sentences"))
    share = F.col("sentences") / F.sum("sentences").over(Window.partitionBy("_doc"))
    return said.withColumn("share", share).where(F.col("subject").isNotNull()).select(F.col("_doc").alias(doc_id), "subject", "sentences", "share")
