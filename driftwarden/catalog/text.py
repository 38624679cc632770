"""Text cleaning over whole documents and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from driftwarden.catalog.registry import query, rounded
from driftwarden.functions import text as X
from driftwarden.operators import text_features as TF
from driftwarden.plans.scored import read

# Put in front of every text, so that each kind of noise occurs.
NOISE = "😀 [nota] <b>¡Hola, señor Müller!</b> (x) https://www.example.com/a?b=1 ana@example.com @ana #tag abc123 “ñandú” "
Q = "'" + NOISE.replace("'", "''") + "' || text"


def documents(spark, sf_dir):
    """Text is heavy per row and the given table is one small file, so it is dealt out by key."""
    return read(spark, sf_dir, "documents").select("doc_id", "text").repartition("doc_id")


def noisy(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", F.concat(F.lit(NOISE), F.col("text")).alias("text"))


def blank_sql(expression: str, *patterns: str) -> str:
    for p in patterns:
        expression = f"regexp_replace({expression}, '{p}', ' ', 'g')"
    return expression


#: Characters with several letters that the tables and the noise may hold.
LIGATURES = [c for c in X._SEVERAL if ord(c) < 0x2200 or 0xFB00 <= ord(c) <= 0xFB06]


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def fold_sql(expression: str) -> str:
    for c in LIGATURES:
        expression = f"replace({expression}, {quoted(c)}, {quoted(X._SEVERAL[c])})"
    return f"regexp_replace(translate({expression}, {quoted(X.FOLD_FROM)}, {quoted(X.FOLD_TO)}), '{X.NON_ASCII}', '', 'g')"


#: The references that the tables and the noise hold, the ampersand last.
REFERENCES = {"copy": "©", "middot": "·", "eacute": "é", "#233": "é", "nbsp": "\u00a0", "lt": "<", "gt": ">", "quot": '"', "#39": "'", "amp": "&"}


def html_sql(expression: str) -> str:
    expression = f"regexp_replace({expression}, '{X.TAG}', '', 'g')"
    for name, character in REFERENCES.items():
        expression = f"regexp_replace({expression}, '&{name};?', {quoted(character)}, 'g')"
    return expression


def tildes_sql(expression: str) -> str:
    return f"translate({expression}, '{X.TILDES[0]}', '{X.TILDES[1]}')"


def squeeze_sql(expression: str) -> str:
    return f"lower(trim({blank_sql(expression, X.WHITESPACE)}))"


# The words these queries drop: a parameter of the operators, whose default is Spark's own list (functions.text.stop_words).
STOP_WORDS = (
    "a al algo ante con como cuando de del desde donde el ella ellos en entre era es esta este esto está fue ha hay la las le lo "
    "los me mi muy más nada ni no nos o para pero por porque que quien se ser si sin sobre son su sus también te tu un una uno y "
    "ya yo about after all an and any are as at be because been before being but by can did do does for from had has have he her "
    "here him his how i if in into is it its itself just more most my nor not now of off on once only or other our out over own "
    "same she should so some such than that the their them then there these they this those through to too under until up very "
    "was we were what when where which while who whom why will with you your"
).split()


def stop_sql(expression: str) -> str:
    words = ", ".join(f"'{w}'" for w in STOP_WORDS)
    return f"array_to_string(list_filter(string_split({expression}, ' '), lambda w: w NOT IN ({words})), ' ')"


def simple(name: str, function, expression: str, rows=noisy, source: str = "documents", key: str = "doc_id") -> None:
    @query(name, f"SELECT {key}, {expression} AS text FROM {source}")
    def run(spark, sf_dir):
        return rows(spark, sf_dir).withColumn("text", function(F.col("text")))


def pages(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", F.col("html").alias("text"))


URL_SQL = blank_sql(Q, X.URL)

simple("strip_emoji", X.strip_emoji, blank_sql(Q, X.EMOJI))
simple("strip_brackets", X.strip_brackets, blank_sql("html", X.SQUARE, X.ANGLE, X.ROUND), pages, "pages", "page_id")
simple("strip_urls", X.strip_urls, URL_SQL)
simple("fold_accents", X.fold_accents, fold_sql(Q))
simple("strip_html", X.strip_html, html_sql("html"), pages, "pages", "page_id")
simple("strip_handles", X.strip_handles, blank_sql(Q, X.EMAIL, X.MENTION, X.HASHTAG))
simple(
    "strip_punct_numbers",
    X.strip_punct_numbers,
    blank_sql(Q, X.PUNCTUATION, X.WORD_WITH_DIGIT, X.QUOTES, X.NOT_WORD),
)
simple("squeeze_space_lower", X.squeeze_space_lower, squeeze_sql(Q))


@query("remove_stopwords", f"SELECT doc_id, {stop_sql(squeeze_sql(Q))} AS text FROM documents")
def _stop(spark, sf_dir):
    text = X.remove_stopwords(X.squeeze_space_lower(F.col("text")), STOP_WORDS)
    return noisy(spark, sf_dir).withColumn("text", text)


def clean_sql(expression: str) -> str:
    expression = blank_sql(expression, X.EMOJI, X.SQUARE, X.ANGLE, X.ROUND, X.URL)
    expression = blank_sql(html_sql(fold_sql(expression)), X.EMAIL, X.MENTION, X.HASHTAG)
    expression = blank_sql(expression, X.PUNCTUATION, X.WORD_WITH_DIGIT, X.QUOTES, X.NOT_WORD)
    return stop_sql(squeeze_sql(tildes_sql(expression)))


@query("clean_text", f"SELECT doc_id, {clean_sql(Q)} AS text FROM documents")
def _clean(spark, sf_dir):
    return noisy(spark, sf_dir).withColumn("text", X.clean_text(F.col("text"), STOP_WORDS))


@query("clean_text_exact")
def _clean_exact(spark, sf_dir):
    return noisy(spark, sf_dir).withColumn("text", X.clean_text(F.col("text"), STOP_WORDS, exact=True))


@query("strip_html_exact")
def _html_exact(spark, sf_dir):
    return pages(spark, sf_dir).withColumn("text", X.strip_html_exact(F.col("text")))


@query("fold_accents_exact")
def _fold_exact(spark, sf_dir):
    return noisy(spark, sf_dir).withColumn("text", X.fold_accents_exact(F.col("text")))


REVIEWS = f"""WITH c AS (SELECT d.doc_id, {clean_sql('text')} AS text, CASE quality WHEN 0 THEN 'bad' WHEN 1 THEN 'good' END AS quality
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
f AS (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM c WHERE text <> '')
SELECT doc_id, text, quality, 'R_' || (row_number() OVER (ORDER BY doc_id) - 1) AS id_review FROM f WHERE rn = 1"""


@query("review_table", REVIEWS)
def _reviews(spark, sf_dir):
    labelled = documents(spark, sf_dir).join(
        read(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id"
    )
    return TF.review_table(labelled, "doc_id", "text", "quality", {0: "bad", 1: "good"}, STOP_WORDS)


TOKENS = f"""WITH tokens AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '{TF.TOKEN}')) AS token FROM documents),
counts AS (SELECT doc_id, token, count(*) AS tf FROM tokens GROUP BY ALL),
vocabulary AS (SELECT token, count(*) AS df FROM counts GROUP BY token HAVING count(*) >= 3)"""


@query("bag_of_words", f"{TOKENS} SELECT doc_id, token, tf FROM counts JOIN vocabulary USING (token)")
def _bag(spark, sf_dir):
    return TF.bag_of_words(documents(spark, sf_dir), "doc_id", "text", 3)


@query(
    "tfidf",
    f"""{TOKENS}, raw AS (SELECT doc_id, token, (1 + ln(tf)) * (ln((1.0::DOUBLE + (SELECT count(*) FROM documents)) / (1 + df)) + 1)
      AS raw FROM counts JOIN vocabulary USING (token))
    SELECT doc_id, token, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)), 6) AS weight FROM raw""",
)
def _tfidf(spark, sf_dir):
    return rounded(TF.tfidf(documents(spark, sf_dir), "doc_id", "text", 3))
