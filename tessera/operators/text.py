"""Text preparation, TF-IDF and near-duplicate search (X-01 … X-07).

Documents become a long postings table (doc, term, tf) — the sparse matrix
in relational form — so vocabulary statistics are group-bys, IDF is a join on
the term, and similarity search is a join on the term restricted to each
document's prefix terms (exact for a cosine threshold, see
:func:`cosine_pairs`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.blocks import EPS, largest, near_links, near_pairs, packed
from tessera.operators.quality import drop_missing, normalise_category
from tessera.session import reliable_checkpoint, written

# A token is a run of two or more letters, digits or underscores
# after lower-casing (the default token rule of the study's vectoriser).
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"


def tokens(text: Column | str) -> Column:
    """Maximal runs of letters/digits/underscore of length ≥ 2, lower-cased.

    Splitting on the complement class and keeping pieces of length ≥ 2 gives
    exactly the matches of ``TOKEN_PATTERN`` and is ~2.5× cheaper than a
    matching scan (``regexp_extract_all``) in the JVM."""
    t = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.lower(t), r"[^\p{L}\p{N}_]+"), lambda w: F.length(w) >= 2)


# ---------------------------------------------------------------------- X-01
def clean_texts(df: DataFrame, id_col: str, text: str, label: str):
    """X-01: project, drop rows with a missing text or label, normalise the
    label (trim, '&' → '', spaces → '_'), drop exact (text, label) copies
    keeping the smallest id. Returns (clean, audit).

    The keep-first dedup is an aggregate (``min(id)`` per key), not a window,
    so a copy group holding a third of the rows is combined map-side."""
    base = df.select(id_col, text, label)
    nonnull = drop_missing(base, [text, label]).withColumn(label, normalise_category(label))
    clean = nonnull.groupBy(text, label).agg(F.min(id_col).alias(id_col)).select(id_col, text, label)
    audit = base.agg(F.count(F.lit(1)).alias("n_rows")).unionByName(
        nonnull.agg(F.count(F.lit(1)).alias("n_non_null")), allowMissingColumns=True).unionByName(
        clean.agg(F.count(F.lit(1)).alias("n_unique")), allowMissingColumns=True).agg(
        F.max("n_rows").alias("n_rows"), F.max("n_non_null").alias("n_non_null"),
        F.max("n_unique").alias("n_unique"))
    return clean, audit


# ---------------------------------------------------------------------- X-02
def label_encoder(df: DataFrame, label: str) -> dict:
    """X-02: sorted classes → 0 … k−1 (the class list is bounded by k)."""
    classes = sorted(r[0] for r in df.select(label).distinct().collect() if r[0] is not None)
    return {c: i for i, c in enumerate(classes)}


def encode(df: DataFrame, label: str, mapping: dict, out: str = "label_idx") -> DataFrame:
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    return df.withColumn(out, m[F.col(label)])


def decode(df: DataFrame, col: str, mapping: dict, out: str) -> DataFrame:
    inv = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(v), F.lit(k))])
    return df.withColumn(out, inv[F.col(col)])


# ---------------------------------------------------------------- X-03 / X-04
def postings(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """(doc, term, tf) from the token rule. Tokenising is the CPU-heavy step and
    runs in the tasks that scan the texts; their number follows
    ``spark.sql.files.maxPartitionBytes``."""
    src = df.select(F.col(id_col).alias("doc"), F.col(text).alias("__text"))
    return (src.select("doc", F.explode(tokens("__text")).alias("term"))
            .groupBy("doc", "term").agg(F.count(F.lit(1)).alias("tf")))


def fit_vocabulary(post: DataFrame, min_df: int = 1, max_features: int | None = None,
                   n_docs: int | None = None) -> DataFrame:
    """X-03: (term, df, total, idf) for terms with df ≥ min_df, the
    ``max_features`` most frequent by total count (ties by term).
    IDF = ln((1 + n) / (1 + df)) + 1 (smoothed)."""
    if n_docs is None:
        n_docs = post.select("doc").distinct().count()
    stats = post.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total")) \
        .filter(F.col("df") >= min_df)
    if max_features:
        stats = stats.orderBy(F.col("total").desc(), F.col("term")).limit(max_features)
    return stats.withColumn("idf", F.log((1.0 + n_docs) / (1.0 + F.col("df"))) + 1.0) \
                .withColumn("n_docs", F.lit(n_docs).cast("long"))


def tfidf(post: DataFrame, vocab: DataFrame) -> DataFrame:
    """X-04: (doc, term, w) with w = tf·idf over vocabulary terms, each doc
    L2-normalised; the vocabulary is joined on the term (broadcast by size
    when it fits, shuffled otherwise)."""
    w = post.join(vocab.select("term", "idf"), on="term", how="inner") \
        .withColumn("w", F.col("tf") * F.col("idf"))
    # the norm is a window over one document's terms (bounded by its length)
    norm = F.sqrt(F.sum(F.col("w") ** 2).over(Window.partitionBy("doc")))
    return w.select("doc", "term", (F.col("w") / norm).alias("w"))


def matrix_stats(weights: DataFrame, n_docs: int, vocab: DataFrame) -> DataFrame:
    """X-05: vocabulary size, stored entries and density nnz / (docs · terms)."""
    v = vocab.count()
    return weights.agg(F.count(F.lit(1)).alias("nnz")).select(
        F.lit(v).cast("long").alias("vocabulary"), "nnz",
        (F.col("nnz") / F.lit(float(n_docs * v))).alias("density"))


# ---------------------------------------------------------------------- X-06
def numbered(vocab: DataFrame, name: str) -> DataFrame:
    """``vocab`` written once, every term with a number of its own, ascending by
    document frequency, then term: postings then travel, sort and join on longs
    instead of strings."""
    return written(vocab.orderBy("df", "term").withColumn("term_id", F.monotonically_increasing_id()), name)


def ranked_weights(post: DataFrame, vocab: DataFrame) -> DataFrame:
    """(doc, term, w, df, rest) for a :func:`numbered` vocabulary: term number,
    TF-IDF weight (unit norm per document), document frequency, and the norm of
    this term and all later terms of the document in one global order —
    document frequency ascending, then term. The order is a composite key, so
    no global ranking of the vocabulary is needed; norm and running norm are
    one window over the terms of each document, with one sort."""
    w = post.join(vocab.select("term", "term_id", "df", "idf"), on="term") \
        .select("doc", F.col("term_id").alias("term"), (F.col("tf") * F.col("idf")).alias("w"), "df")
    win = Window.partitionBy("doc").orderBy(F.col("df").desc(), F.col("term").desc())
    square = F.col("w") ** 2
    norm = F.sqrt(F.sum(square).over(win.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    rest = F.sqrt(F.sum(square).over(win.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return w.select("doc", "term", "w", "df", norm.alias("__norm"), rest.alias("__rest")) \
        .select("doc", "term", (F.col("w") / F.col("__norm")).alias("w"), "df",
                (F.col("__rest") / F.col("__norm")).alias("rest"))


def _prefix(ranked: DataFrame, threshold: float) -> DataFrame:
    """The leading run of every document's terms whose ``rest`` reaches the threshold."""
    return ranked.filter(F.col("rest") >= threshold - EPS)


def _finished(cand: DataFrame, test_r: DataFrame, train_r: DataFrame, threshold: float) -> DataFrame:
    """(test_doc, train_doc, cosine) of the candidates that reach the threshold:
    ``acc`` plus the products of the shared terms after (m_df, m_term)."""
    tw = test_r.select(F.col("doc").alias("test_doc"), "term", "df", F.col("w").alias("wt"))
    # The expanded side (candidates × test tail terms) is by far the larger;
    # the train postings are unique on (train doc, term), so each task builds
    # a hash table of its slice of them instead of sorting the expansion.
    rw = train_r.select(F.col("doc").alias("train_doc"), "term", F.col("w").alias("wr")).hint("shuffle_hash")
    after = (F.col("df") > F.col("m_df")) | ((F.col("df") == F.col("m_df")) & (F.col("term") > F.col("m_term")))
    rest = (cand.join(tw, on="test_doc").filter(after)
            .join(rw, on=["train_doc", "term"])
            .groupBy("test_doc", "train_doc").agg(F.sum(F.col("wt") * F.col("wr")).alias("__rest")))
    return (cand.join(rest, on=["test_doc", "train_doc"], how="left")
            .select("test_doc", "train_doc", (F.col("acc") + F.coalesce("__rest", F.lit(0.0))).alias("cosine"))
            .filter(F.col("cosine") >= threshold - EPS))


def cosine_pairs(test_r: DataFrame, train_r: DataFrame, threshold: float, some: bool = False) -> DataFrame:
    """All (test doc, train doc) pairs with cosine ≥ threshold, exactly, for
    tables of :func:`ranked_weights`.

    Prefix filtering: the prefix of a unit vector is the leading run of its
    terms (rarest first) whose ``rest`` norm is ≥ the threshold. If two vectors
    share no prefix term, the first shared term lies in a suffix of norm
    < threshold and Cauchy–Schwarz bounds the cosine below it; so candidates
    are the pairs that share a prefix term.

    Candidates are formed, bounded and finished inside the tasks, block by
    block (:mod:`tessera.operators.blocks`): they never become shuffled rows.
    With ``some`` not all pairs are returned, but one at least of every test
    document that has any.
    """
    te, tr = (packed(r, threshold, f"x06-{k}-blocks") for r, k in ((test_r, "test"), (train_r, "train")))
    return near_pairs(te, tr, threshold, some)


def star_links(test_r: DataFrame, train_r: DataFrame, threshold: float, earlier: bool = False) -> DataFrame:
    """(test_doc, train_doc, cosine): at most one verified link per test doc.

    Every prefix term names one train doc, the smallest that has it; each test
    doc is compared with the doc that most of its prefix weight names. All
    members of a template family name the same doc, so a family of m documents
    costs m comparisons. Not a complete search: links found here spare the
    exact one. With ``earlier`` only smaller ids are partners."""
    named = _prefix(train_r, threshold).groupBy("term").agg(F.min("doc").alias("train_doc"))
    votes = _prefix(test_r, threshold).select(F.col("doc").alias("test_doc"), "term", "w").join(named, "term")
    if earlier:
        votes = votes.filter(F.col("train_doc") < F.col("test_doc"))
    pick = votes.groupBy("test_doc", "train_doc").agg(F.sum(F.col("w") ** 2).alias("s")) \
        .groupBy("test_doc").agg(F.max_by("train_doc", F.struct("s", -F.col("train_doc"))).alias("train_doc"))
    whole = pick.select("test_doc", "train_doc", F.lit(0.0).alias("acc"), F.lit(-1).cast("long").alias("m_df"),
                        F.lit(-1).cast("long").alias("m_term"))
    return _finished(whole, test_r, train_r, threshold)


def near_duplicates(train: DataFrame, test: DataFrame, id_col: str, text: str, threshold: float = 0.9,
                    max_features: int | None = None, best: bool = False) -> tuple[DataFrame, DataFrame]:
    """X-06: for each test text, whether some train text reaches the cosine
    threshold; and the summary (n_test, n_near_duplicate, pct).

    The vectoriser is fitted on train only. Identical texts are collapsed
    before the search (a group of copies becomes one vector with a count).
    Test texts with a verified star link are settled; only the others are
    searched exhaustively. ``max_cosine`` is then the cosine of a text that
    reaches the threshold; with ``best`` every test text is searched
    exhaustively and it is the largest one (NULL below the threshold)."""
    tr_u = train.groupBy(text).agg(F.min(id_col).alias(id_col))
    te_u = test.groupBy(text).agg(F.min(id_col).alias(id_col), F.count(F.lit(1)).alias("__copies"))
    # Read several times below: written once into the shared folder.
    tr_post = written(postings(tr_u, id_col, text), "x06-train-terms")
    vocab = numbered(fit_vocabulary(tr_post, 1, max_features, n_docs=tr_u.count()), "x06-vocabulary")
    tr_r = written(ranked_weights(tr_post, vocab), "x06-train")
    te_r = written(ranked_weights(postings(te_u, id_col, text), vocab), "x06-test")
    if best:
        pairs = cosine_pairs(te_r, tr_r, threshold)
    else:
        star = written(star_links(te_r, tr_r, threshold), "x06-star")
        open_r = te_r.join(star.select(F.col("test_doc").alias("doc")), "doc", "left_anti")
        pairs = star.unionByName(cosine_pairs(open_r, tr_r, threshold, some=True))
    top = pairs.groupBy("test_doc").agg(F.max("cosine").alias("max_cosine"))
    per_text = te_u.join(top, te_u[id_col] == top["test_doc"], "left") \
        .select(F.col(id_col), "__copies", "max_cosine")
    summary = per_text.agg(
        F.sum("__copies").alias("n_test"),
        F.sum(F.when(F.col("max_cosine").isNotNull(), F.col("__copies")).otherwise(0)).alias("n_near_duplicate")) \
        .withColumn("pct", F.col("n_near_duplicate") * 100.0 / F.col("n_test"))
    return per_text, summary


def largest_similarity(test_r: DataFrame, train_r: DataFrame) -> DataFrame:
    """(doc, max_cosine): the largest cosine of every test document to any train
    document, exactly and without a threshold, for tables of
    :func:`ranked_weights`. Documents that share no term are absent.

    All test blocks are multiplied with all train blocks; what leaves a task is
    one number per test document of its block. Time grows with test times train
    texts, as the exact answer asks; disk only with the postings."""
    te, tr = (packed(r, 1.0, f"x06-{k}-blocks") for r, k in ((test_r, "test"), (train_r, "train")))
    return largest(te, tr).groupBy("doc").agg(F.max("cosine").alias("max_cosine"))


def similarity_report(train: DataFrame, test: DataFrame, id_col: str, text: str,
                      threshold: float = 0.9) -> tuple[DataFrame, DataFrame]:
    """X-06 with the largest similarity of every test text (0 where it shares no
    term with a train text), and the summary (n_test, n_near_duplicate, pct,
    mean_similarity), copies of a test text counted each."""
    tr_u = train.groupBy(text).agg(F.min(id_col).alias(id_col))
    te_u = written(test.groupBy(text).agg(F.min(id_col).alias(id_col), F.count(F.lit(1)).alias("copies")), "x06-test-texts")
    tr_post = written(postings(tr_u, id_col, text), "x06-train-terms")
    vocab = numbered(fit_vocabulary(tr_post, n_docs=tr_u.count()), "x06-vocabulary")
    tr_r = written(ranked_weights(tr_post, vocab), "x06-train")
    te_r = written(ranked_weights(postings(te_u, id_col, text), vocab), "x06-test")
    best = largest_similarity(te_r, tr_r).withColumnRenamed("doc", id_col)
    per_text = written(te_u.select(id_col, "copies").join(best, id_col, "left")
                       .withColumn("max_cosine", F.coalesce("max_cosine", F.lit(0.0))), "x06-largest")
    near = F.sum(F.when(F.col("max_cosine") >= threshold - EPS, F.col("copies")).otherwise(0))
    n = F.sum("copies")
    return per_text, per_text.agg(n.alias("n_test"), near.alias("n_near_duplicate"), (near * 100.0 / n).alias("pct"),
                                  (F.sum(F.col("copies") * F.col("max_cosine")) / n).alias("mean_similarity"))


# ---------------------------------------------------------------------- X-07
def connected_components(edges: DataFrame, src: str = "a", dst: str = "b") -> DataFrame:
    """X-07: (node, component = smallest node id reachable).

    Each round (1) takes the minimum label over a node and its neighbours and
    (2) jumps: a node adopts the label of its label's node when smaller, so
    label chains halve and a path of length d settles in O(log d) rounds
    instead of d. Labels are always ids of the same component and only
    decrease; rounds continue until step (1) changes nothing, i.e. every edge
    joins equal labels — the exact component minimum. There is no round cap.
    Both steps are an equi-join to a table unique on the node and a min
    aggregate (partial, map-side), so a hub node or a giant component is
    split by AQE's skew handling rather than sent to one task. Lineage is cut
    every few rounds with a reliable checkpoint into the shared folder."""
    e = edges.select(F.col(src).alias("a"), F.col(dst).alias("b"))
    e = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    e = reliable_checkpoint(e)
    labels = e.select(F.col("a").alias("node")).distinct().withColumn("comp", F.col("node"))
    i = 0
    while True:
        prop = e.join(labels, e.a == labels.node).select(F.col("b").alias("node"), F.col("comp"))
        new = labels.unionByName(prop).groupBy("node").agg(F.min("comp").alias("comp"))
        changed = new.join(labels.withColumnRenamed("comp", "__old"), on="node") \
            .filter(F.col("comp") != F.col("__old")).limit(1).count()
        if changed == 0:
            return labels
        hop = new.select(F.col("node").alias("__via"), F.col("comp").alias("__c2"))
        labels = new.join(hop, new.comp == hop.__via, "left") \
            .select("node", F.least("comp", F.coalesce("__c2", "comp")).alias("comp"))
        i += 1
        if i % 2 == 0:
            labels = reliable_checkpoint(labels)


def links_between(ranked: DataFrame, comps: DataFrame, threshold: float) -> DataFrame:
    """(test_doc, train_doc, cosine): links whose ends lie in different
    components of ``comps`` (node, component; an unlisted document is its own).

    Candidates are formed and verified inside the tasks, block by block, and a
    pair is verified only while its ends are not yet joined there; so links are
    returned that join the same components as all of them, at most one fewer
    than the documents of a pair of blocks."""
    parts = ranked.join(comps.withColumnRenamed("node", "doc"), "doc", "left").filter(F.col("doc").isNotNull()) \
        .withColumn("comp", F.coalesce("comp", "doc"))
    return near_links(packed(parts, threshold, "x07-blocks", "comp"), threshold)


def remove_near_duplicates(df: DataFrame, id_col: str, text: str, threshold: float = 0.9) -> DataFrame:
    """X-07: drop texts that are near-copies (cosine ≥ threshold, transitively)
    of a text with a smaller id; exact copies collapse first.

    Star links join template families first, at one comparison per document;
    the exact search then looks only for links between different components."""
    u = df.groupBy(text).agg(F.min(id_col).alias(id_col))
    post = written(postings(u, id_col, text), "x07-terms")
    vocab = numbered(fit_vocabulary(post, n_docs=u.count()), "x07-vocabulary")
    ranked = written(ranked_weights(post, vocab), "x07-weights")
    star = connected_components(star_links(ranked, ranked, threshold, earlier=True), "test_doc", "train_doc")
    star = written(star, "x07-star")
    across = links_between(ranked, star, threshold).select(F.col("test_doc").alias("a"), F.col("train_doc").alias("b"))
    inside = star.filter("node <> comp").select(F.col("node").alias("a"), F.col("comp").alias("b"))
    comps = connected_components(across.unionByName(inside))
    dropped = comps.filter(F.col("node") != F.col("comp")).select(F.col("node").alias(id_col))
    return u.join(dropped, on=id_col, how="left_anti")
