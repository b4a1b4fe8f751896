"""The operators of this package as queries over whole tables, and SQL where it can say the same."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableflow.llm import ann, bpe, extraction, fim, jaccard, linededup, packing, phrases, quality, search, simhash, tokenfile, wordpiece
from tableflow.llm.common import table
from tableflow.session import fresh_path

BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def op1_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    """A score of every document, learned from the labels that are not held out."""
    docs = table(spark, sf, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf, "labels")))


def op2_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    """The main text of every page."""
    return extraction.main_texts(table(spark, sf, "pages"))


def op3_bpe_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of every document and the text decoded from them, as digests."""
    return bpe.digests(table(spark, sf, "documents"), BYTES)


def op4_nearest_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    """The 5 nearest vectors of each whose id is divisible by 50."""
    return ann.nearest(table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op5_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Words and greedy word pieces of every document."""
    return wordpiece.count_pieces(table(spark, sf, "documents"), BYTES)


def op6_simhash_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(table(spark, sf, "documents"))


def op7_top_k_search(spark: SparkSession, sf: str) -> DataFrame:
    """The 10 best documents for each whose id is divisible by 100, with its whole text as the query."""
    return search.top_k(table(spark, sf, "documents"), F.col("doc_id") % 100 == 0, k=10)


def op8_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every document without later copies of repeated runs of lines: its lines, those removed, and a digest."""
    return linededup.dedup_lines(table(spark, sf, "documents")).select(
        "doc_id", "lines_before", "lines_removed", F.md5("text").alias("text_md5"))


def op9_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    """All documents in sequences of 4096 tokens."""
    return packing.pack(packing.cut_pieces(table(spark, sf, "documents"), WORDS, end_id=1))


def op10_token_files(spark: SparkSession, sf: str) -> DataFrame:
    """All documents' ids, written in the package's file format and read back."""
    target = fresh_path(spark, "tokens")
    tokenfile.write_tokens(table(spark, sf, "documents"), target, WORDS, end_id=2)
    return tokenfile.read_digests(spark, target)


def op11_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    """Size of the shingle set and component of every document, at a similarity of 0.8."""
    return jaccard.near_documents(table(spark, sf, "documents"))


def op12_fill_in_middle(spark: SparkSession, sf: str) -> DataFrame:
    """Every document rearranged to fill in its middle, and restored, as digests."""
    done = fim.restored(fim.fill_in_middle(table(spark, sf, "documents")))
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2("restored", 256).alias("restored_sha256"))


def op13_phrase_mining(spark: SparkSession, sf: str) -> DataFrame:
    """The 2,000 best phrases of each language that occur 100 times or more."""
    return phrases.collocations(table(spark, sf, "documents"))


QUERIES = (op1_quality_classifier, op2_html_extraction, op3_bpe_round_trip, op4_nearest_neighbours,
           op5_token_counts, op6_simhash_near_duplicates, op7_top_k_search, op8_line_dedup, op9_best_fit_packing, op10_token_files,
           op11_jaccard_join, op12_fill_in_middle, op13_phrase_mining)

# A window is named by its very lines here. It starts or ends at each line and is the smallest of
# 150 characters that does; a line goes if a window that holds it has an earlier copy.
LINE_DEDUP = """
WITH texts AS (SELECT doc_id, text, string_split(text, chr(10)) AS lines FROM documents),
each AS (SELECT doc_id, i, lines, sum(len(lines[i])) OVER (PARTITION BY doc_id ORDER BY i) AS upto, len(lines[i]) AS size
         FROM (SELECT doc_id, lines, unnest(generate_series(1, len(lines))) AS i FROM texts)),
starting AS (SELECT a.doc_id, a.i AS first, min(b.i) AS last FROM each a JOIN each b
             ON a.doc_id = b.doc_id AND b.i >= a.i AND b.upto - a.upto + a.size >= 150 GROUP BY a.doc_id, a.i),
ending AS (SELECT b.doc_id, max(a.i) AS first, b.i AS last FROM each a JOIN each b
           ON a.doc_id = b.doc_id AND b.i >= a.i AND b.upto - a.upto + a.size >= 150 GROUP BY b.doc_id, b.i),
named AS (SELECT w.doc_id, first, last, list_slice(lines, first, last) AS content
          FROM (SELECT * FROM starting UNION SELECT doc_id, first, last FROM ending) w JOIN texts t ON w.doc_id = t.doc_id),
later AS (SELECT doc_id, first, last FROM named
          QUALIFY row_number() OVER (PARTITION BY content ORDER BY doc_id, first) > 1),
gone AS (SELECT DISTINCT e.doc_id, e.i FROM each e JOIN later l ON e.doc_id = l.doc_id AND e.i BETWEEN first AND last),
kept AS (SELECT e.doc_id, string_agg(e.lines[e.i], chr(10) ORDER BY e.i) FILTER (g.i IS NULL) AS text, count(g.i) AS removed, count(*) AS n
         FROM each e LEFT JOIN gone g ON e.doc_id = g.doc_id AND e.i = g.i GROUP BY e.doc_id)
SELECT t.doc_id, coalesce(n, 0) AS lines_before, coalesce(removed, 0) AS lines_removed,
       CASE WHEN t.text IS NOT NULL THEN md5(coalesce(k.text, '')) END AS text_md5
FROM texts t LEFT JOIN kept k ON t.doc_id = k.doc_id
"""

TOP_K = """
WITH words AS (SELECT doc_id, unnest(string_split_regex(regexp_replace(lower(coalesce(text, '')), '[^\\pL\\pN]+', ' ', 'g'), ' ')) AS word
               FROM documents),
tf AS (SELECT doc_id, word, count(*) AS tf FROM words WHERE word <> '' GROUP BY ALL),
lengths AS (SELECT doc_id, sum(tf) AS length FROM tf GROUP BY ALL),
everything AS (SELECT (SELECT count(*) FROM documents) AS n, (SELECT sum(length) FROM lengths)::DOUBLE / (SELECT count(*) FROM documents) AS mean_length),
rarity AS (SELECT word, ln(1 + (n - count(*) + 0.5::DOUBLE) / (count(*) + 0.5::DOUBLE)) AS rarity FROM tf, everything GROUP BY word, n),
shares AS (SELECT q.doc_id AS query_id, d.doc_id, round(1000000 * (rarity * (d.tf::DOUBLE * (1.2::DOUBLE + 1)
               / (d.tf::DOUBLE + 1.2::DOUBLE * (1 - 0.75::DOUBLE + 0.75::DOUBLE * length::DOUBLE / mean_length)))))::HUGEINT AS share
           FROM tf q JOIN tf d ON q.word = d.word JOIN rarity r ON r.word = q.word JOIN lengths l ON l.doc_id = d.doc_id, everything
           WHERE q.doc_id % 100 = 0),
scores AS (SELECT query_id, doc_id, sum(share) AS score FROM shares GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS rank FROM scores)
SELECT query_id, rank::INT AS rank, doc_id, score::DOUBLE / 1000000 AS score FROM ranked WHERE rank <= 10
"""

ORACLES: dict[str, str] = {"op7_top_k_search": TOP_K, "op8_line_dedup": LINE_DEDUP}
