"""Message cleaning and classification on pages, documents, labels and conversations."""

from pyspark.sql import functions as F

from parcelspark.functions import text as tx
from parcelspark.functions.scalars import round_half_up
from parcelspark.operators import classifier as cl
from parcelspark.operators import text as ot
from parcelspark.operators.setops import bucket_of
from parcelspark.sources.tables import written
from suite.groups import bucket_sql
from suite.inputs import with_ctes
from suite.registry import query


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# DuckDB's expressions have no back-references: one alternative per element instead
EMPTY_SQL = "(?is)" + "|".join(rf"<{tag}(?:\s[^<>]*)?>\s*</{tag}\s*>" for tag in tx.EMPTIABLE_ELEMENTS)


# one listed attribute of every tag a pass
ATTRIBUTE_SQL = (rf"""(?is)(<[a-z][a-z0-9]*(?:\s+[^\s=<>"']+(?:\s*=\s*{tx._VALUE})?)*?)"""
                 rf"""\s+(?:{'|'.join(tx.REMOVED_ATTRIBUTES)})\s*=\s*{tx._VALUE}""")


def strip_sql(c: str) -> str:
    for pattern in tx.HTML_REMOVALS:
        c = f"regexp_replace({c}, {quoted(pattern)}, '', 'g')"
    for _ in tx.REMOVED_ATTRIBUTES:
        c = f"regexp_replace({c}, {quoted(ATTRIBUTE_SQL)}, '\\1', 'g')"
    for _ in range(6):  # no page nests empty elements deeper
        c = f"regexp_replace({c}, {quoted(EMPTY_SQL)}, '', 'g')"
    return c


@query("strip_html", f"SELECT page_id, {strip_sql('html')} AS clean FROM {{pages}}")
def strip_html(t):
    return ot.strip_html(t.pages.select("page_id", "html"), "html", "clean").drop("html")


MAIL = """SELECT conv_id, turn, CASE WHEN conv_id % 3 = 0 THEN text ELSE 'From: ' || role || '@mail' || chr(10) ||
  'Subject: Turn ' || CAST(turn AS STRING) || chr(10) || 'X-Id: 5' || chr(10) || chr(10) || text END AS mail
  FROM {conversations}"""


@query("email_subject_body", f"""SELECT conv_id, turn,
CASE WHEN headed THEN regexp_extract(mail, '(?mi)^subject:[ \\t]*([^\\n]*)$', 1) ELSE '' END AS subject,
CASE WHEN NOT headed THEN mail WHEN strpos(mail, chr(10) || chr(10)) > 0
 THEN substr(mail, strpos(mail, chr(10) || chr(10)) + 2) ELSE '' END AS body
FROM (SELECT *, regexp_matches(mail, '^[A-Za-z-]+:[^\\n]*\\n') AS headed FROM ({MAIL}) m) x""")
def email_subject_body(t):
    return ot.email_subject_body(t.sql(MAIL), "mail").drop("mail")


def scrub_sql(c: str) -> str:
    c = f"translate({c}, {quoted(tx.ACCENTED)}, {quoted(tx.BASE)})"
    for char, spelled in tx.SPELLED_OUT.items():
        c = f"replace({c}, {quoted(char)}, {quoted(spelled)})"
    return f"trim(regexp_replace(regexp_replace({c}, '[^\\x00-\\x7F]', '', 'g'), '\\s+', ' ', 'g'))"


@query("scrub_text", f"SELECT doc_id, {scrub_sql('text')} AS plain FROM {{documents}}")
def scrub_text(t):
    return ot.scrub_text(t.documents.select("doc_id", "text"), "text", "plain").drop("text")


# names in Cyrillic or Greek letters, and in Latin ones again; then signs of several letters, marks, and what has no Latin spelling
CYRILLIC, GREEK = ("abvgdezyiklmnoprstuf", "абвгдезйиклмнопрстуф"), ("abgdeziklmnxoprstu", "αβγδεζικλμνξοπρστυ")
MIXED = f"""SELECT p_partkey, CASE WHEN p_partkey % 7 = 6 THEN ' 東 京' ELSE CASE p_partkey % 3 WHEN 0 THEN translate(lower(p_name), '{CYRILLIC[0]}', '{CYRILLIC[1]}')
  WHEN 1 THEN translate(lower(p_name), '{GREEK[0]}', '{GREEK[1]}') ELSE p_name END ||
  CASE p_partkey % 5 WHEN 0 THEN ' Щука Жуков ёж' WHEN 1 THEN ' Θεός ψυχή Ὀδυσσεύς' WHEN 2 THEN ' ﬁn １２ Ⅷ ½ ™' WHEN 3 THEN ' 東京 е́'
  ELSE '' END END AS text FROM {{part}}"""


@query("scrub_scripts", """SELECT p_partkey, CASE WHEN p_partkey % 7 = 6 THEN '? ?' ELSE CASE WHEN p_partkey % 3 < 2 THEN lower(p_name) ELSE p_name END ||
CASE p_partkey % 5 WHEN 0 THEN ' Shchuka Zhukov ezh' WHEN 1 THEN ' Theos psuche Odusseus' WHEN 2 THEN ' fin 12 VIII 1/2 TM' WHEN 3 THEN ' e'
 ELSE '' END END AS plain FROM {part}""")
def scrub_scripts(t):
    return ot.scrub_text(t.sql(MIXED), "text", "plain").drop("text")


NESTED = """SELECT p_partkey, p_name, CAST(p_partkey % 21 AS INTEGER) AS depth, CAST(p_partkey % 13 AS INTEGER) AS n FROM {part}"""


@query("strip_nested_html", f"""SELECT p_partkey, '<div data-x="1">' || p_name || CASE WHEN depth = 0 THEN chr(10) || ' ' ELSE '' END ||
'<p checked lang="id=3">a > b</p></div>' AS clean FROM ({NESTED}) x""")
def strip_nested_html(t):
    """Up to 20 empty elements in each other, up to 12 listed attributes, some without a value, and one that only looks like one."""
    page = F.concat(
        F.lit("<div"), F.expr("array_join(transform(sequence(0, n), i -> if(i % 3 = 0, ' class', concat(' id=\"', i, '\"'))), '')"), F.lit(' data-x="1" name>'),
        F.col("p_name"), F.expr("repeat('<span title=\"x\">', depth)"), F.lit("\n <b></b>"), F.expr("repeat('</span>', depth)"),
        F.lit("<i><u><b></b></u> <em></em></i>"), F.lit('<p checked lang="id=3" href=\'y\'>a > b</p></div><style>p</style>'))
    return ot.strip_html(t.sql(NESTED).withColumn("html", page), "html", "clean").select("p_partkey", "clean")


TOKENS = """SELECT {0}, w, row_number() OVER (PARTITION BY {0} ORDER BY i) AS i FROM
(SELECT {0}, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM
 (SELECT {0}, string_split_regex(lower(text), '[^a-z0-9]+') AS words FROM {1}) s) u WHERE w <> ''"""


@query("word_ngrams", with_ctes({"tok": TOKENS.format("conv_id, turn", "{conversations}")}, """
SELECT conv_id, turn, w AS ngram FROM tok UNION ALL
SELECT conv_id, turn, w || ' ' || nxt FROM (SELECT *, lead(w) OVER (PARTITION BY conv_id, turn ORDER BY i) AS nxt FROM tok) p
WHERE nxt IS NOT NULL"""))
def word_ngrams(t):
    return ot.word_ngrams(t.conversations.select("conv_id", "turn", "text"), "text", (1, 2))


@query("tfidf", with_ctes({"tok": TOKENS.format("doc_id", "{documents}"),
                           "tf": "SELECT doc_id, w AS ngram, count(*) AS tf FROM tok GROUP BY doc_id, w",
                           "df": "SELECT ngram, count(*) AS df FROM tf GROUP BY ngram",
                           "n": "SELECT CAST(count(DISTINCT doc_id) AS DOUBLE) AS n FROM tok"}, """
SELECT doc_id, tf.ngram, tf, df, floor(tf * ln((n + 1e0) / (df + 1e0)) * 1e6 + 5e-1) / 1e6 AS tfidf
FROM tf JOIN df ON tf.ngram = df.ngram, n"""))
def tfidf(t):
    terms = ot.word_ngrams(t.documents.select("doc_id", "text"), "text", (1,))
    return ot.tfidf(terms, "doc_id", "ngram").withColumn("tfidf", round_half_up("tfidf", 6))


def labelled(t):
    docs = ot.scrub_text(t.documents.select("doc_id", "text").join(t.labels, "doc_id"), "text", "plain")
    split = docs.select("doc_id", F.col("toxic").alias("label"), tx.words_of("plain").alias("single"))
    words = F.concat("single", tx.ngrams_of(F.col("single"), 2))
    # training passes over the rows many times
    return written(split.select("doc_id", "label", words.alias("words")))


@query("train_message_classifier")
def train_message_classifier(t):
    rows = labelled(t)
    outs = []
    for kind in ("elastic_net", "naive_bayes"):
        model = ot.train_message_classifier(rows, "words", kind=kind)
        outs.append(model.transform(rows).select("doc_id", "label", "prediction", F.lit(kind).alias("kind")))
    return outs[0].unionByName(outs[1])


# A document's label is the largest of its labels, its fold a bucket of its id.
MARKED = f"""SELECT d.doc_id, d.text, max(l.toxic) AS label, {bucket_sql('d.doc_id', 4)} AS fold
  FROM {{documents}} d JOIN {{labels}} l ON d.doc_id = l.doc_id GROUP BY d.doc_id, d.text"""
FOLDED = {
    "marked": MARKED, "tok": TOKENS.format("doc_id", "marked"),
    "terms": """SELECT doc_id, w AS ngram FROM tok UNION ALL SELECT doc_id, w || ' ' || nxt FROM
 (SELECT *, lead(w) OVER (PARTITION BY doc_id ORDER BY i) AS nxt FROM tok) p WHERE nxt IS NOT NULL""",
    "folds": "SELECT DISTINCT fold AS k FROM marked",
    "tf": "SELECT doc_id, ngram, count(*) AS n FROM terms GROUP BY doc_id, ngram",
    "seen": """SELECT k, ngram, sum(CASE WHEN label = 0 THEN n ELSE 0 END) AS n0, sum(CASE WHEN label = 1 THEN n ELSE 0 END) AS n1
 FROM tf JOIN marked ON tf.doc_id = marked.doc_id JOIN folds ON fold <> k GROUP BY k, ngram""",
    "size": "SELECT k, sum(n0) AS n0, sum(n1) AS n1, count(*) AS v FROM seen GROUP BY k",
    "prior": """SELECT k, ln((sum(label) + 1e0) / (sum(1 - label) + 1e0)) AS prior FROM marked JOIN folds ON fold <> k GROUP BY k""",
    "said": """SELECT tf.doc_id, sum(tf.n * (ln((seen.n1 + 1e0) / (size.n1 + size.v)) - ln((seen.n0 + 1e0) / (size.n0 + size.v)))) AS said
 FROM tf JOIN marked ON tf.doc_id = marked.doc_id JOIN seen ON seen.k = fold AND seen.ngram = tf.ngram JOIN size ON size.k = fold
 GROUP BY tf.doc_id""",
    "scored": """SELECT marked.doc_id, label, fold, prior + coalesce(said, 0e0) AS score FROM marked JOIN prior ON prior.k = fold
 LEFT JOIN said ON said.doc_id = marked.doc_id"""}


def folded(t):
    marked = t.documents.join(t.labels, "doc_id").groupBy("doc_id", "text").agg(F.max("toxic").alias("label")) \
        .withColumn("fold", bucket_of("doc_id", 4))
    # read by every step of the training: texts are grouped once, and the documents without them are small
    marked = written(marked)
    terms = written(ot.word_ngrams(marked.select("doc_id", "text"), "text", (1, 2)))
    docs = written(marked.drop("text"))
    return cl.train_naive_bayes(docs, terms, "doc_id", "label", fold="fold", folds=4).score(docs, terms, "doc_id", "fold")


@query("train_naive_bayes", with_ctes(FOLDED, """SELECT doc_id, label, fold, floor(score * 1e6 + 5e-1) / 1e6 AS score,
CASE WHEN score > 0 THEN 1 ELSE 0 END AS prediction FROM scored"""))
def train_naive_bayes(t):
    return folded(t).withColumn("score", round_half_up(F.col("score"), 6))


@query("holdout_classification", with_ctes(FOLDED, """SELECT fold, count(*) AS n,
CAST(count(*) FILTER (label = 1 AND score > 0) AS DOUBLE) / nullif(count(*) FILTER (label = 1), 0) AS recall,
CAST(count(*) FILTER (label = 1 AND score > 0) AS DOUBLE) / nullif(count(*) FILTER (score > 0), 0) AS precision,
CAST(count(*) FILTER ((label = 1) = (score > 0)) AS DOUBLE) / count(*) AS accuracy,
2e0 * count(*) FILTER (label = 1 AND score > 0) / nullif(count(*) FILTER (label = 1) + count(*) FILTER (score > 0), 0) AS f1
FROM scored GROUP BY fold"""))
def holdout_classification(t):
    return ot.classification_metrics(folded(t), ["fold"], "label", "prediction")


@query("dictionary", with_ctes({"tok": TOKENS.format("doc_id", "{documents}")}, """
SELECT w AS ngram, CAST(row_number() OVER (ORDER BY w) - 1 AS BIGINT) AS term_id FROM (SELECT DISTINCT w FROM tok) x"""))
def dictionary(t):
    return cl.dictionary(ot.word_ngrams(t.documents.select("doc_id", "text"), "text", (1,)))


@query("classification_metrics", """SELECT lang, count(*) AS n,
CAST(tp AS DOUBLE) / nullif(tp + fn, 0) AS recall, CAST(tp AS DOUBLE) / nullif(tp + fp, 0) AS precision,
CAST(ok AS DOUBLE) / n AS accuracy, 2e0 * tp / nullif(2 * tp + fp + fn, 0) AS f1 FROM (
SELECT lang, count(*) AS n, count(*) FILTER (quality = 1 AND p = 1) AS tp, count(*) FILTER (quality <> 1 AND p = 1) AS fp,
 count(*) FILTER (quality = 1 AND p <> 1) AS fn, count(*) FILTER ((quality = 1) = (p = 1)) AS ok FROM
 (SELECT d.lang, l.quality, d.n_chars % 2 AS p FROM {labels} l JOIN {documents} d ON l.doc_id = d.doc_id) x GROUP BY lang) y
""".replace("SELECT lang, count(*) AS n,\nCAST(tp", "SELECT lang, n,\nCAST(tp"))
def classification_metrics(t):
    rows = t.labels.join(t.documents, "doc_id").withColumn("p", F.col("n_chars") % 2)
    return ot.classification_metrics(rows, ["lang"], "quality", "p")


@query("union_labelled_sources", """
SELECT text, 'documents' AS source_name, 0 AS label FROM {documents} UNION ALL
SELECT html, 'pages', 1 FROM {pages} UNION ALL SELECT text, 'conversations', 1 FROM {conversations}""")
def union_labelled_sources(t):
    return ot.union_labelled_sources({
        "documents": t.documents.select("text"), "pages": t.pages.select(F.col("html").alias("text")),
        "conversations": t.conversations.select("text")}, bad=["pages", "conversations"])
