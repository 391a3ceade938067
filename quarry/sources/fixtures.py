"""Wiki-shaped views derived from the driver's tables (FIXTURES.md V1, V2).

The same SQL text runs in Spark and in the DuckDB oracle, so both engines
read identical rows.  ``wiki_pages`` is in raw dump form (``&lt;`` escapes):
apply ``unescape`` first, as the XML reader would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

WIKI_PAGES_SQL = """SELECT doc_id AS page_id,
       CASE WHEN doc_id % 20 = 0 THEN 10 WHEN doc_id % 20 = 1 THEN 828
            WHEN doc_id % 20 = 2 THEN 4 ELSE 0 END AS ns,
       CASE WHEN doc_id % 20 = 0 THEN concat('Template:T', CAST(CAST(floor(doc_id / 20) AS BIGINT) % 8 AS STRING))
            WHEN doc_id % 20 = 1 THEN concat('Module:M', CAST(doc_id AS STRING))
            WHEN doc_id % 20 = 2 THEN concat('Project:P', CAST(doc_id AS STRING))
            WHEN doc_id % 20 = 3 THEN concat('Doc ', CAST(doc_id AS STRING), '/sub/', lang)
            ELSE concat('Doc ', CAST(doc_id AS STRING)) END AS title,
       CASE WHEN doc_id % 20 = 4 THEN concat('Doc ', CAST(doc_id + 1 AS STRING)) ELSE NULL END AS redirect_title,
       doc_id + 100000 AS rev_id,
       CASE WHEN doc_id % 20 = 0 AND doc_id % 160 = 140
            THEN '#REDIRECT [[Template:T1]]'
            WHEN doc_id % 20 = 0
            THEN concat('<noinclude>', lang, '</noinclude><!-- c --><includeonly>', source, ':{{{1|none}}}/{{{lang|xx}}}</includeonly>')
            ELSE concat(
              CASE WHEN doc_id % 20 = 5 THEN concat('{{disambig}}', chr(10)) ELSE '' END,
              '{{T', CAST(doc_id % 10 AS STRING), '|', source, CASE WHEN doc_id % 2 = 0 THEN concat('|lang=', lang) ELSE '' END, '}} ',
              '''''''bold''''''', ' ', '''''it''''', ' [[', source, '|', lang, ']]s [[', source, ']] [[Category:', lang, ']]x ',
              '[http://e.org/', lang, ' site] [http://e.org] &amp;eacute;&#233;&lt;ref&gt;r&lt;/ref&gt; __NOTOC__', chr(10),
              '{| class=t', chr(10), '| a {| in |} b', chr(10), '|}', chr(10),
              '== Head ==', chr(10), text, chr(10),
              '=== Sub ===', chr(10), '* one', chr(10), '* two', chr(10), '# n1', chr(10), '# n2', chr(10), chr(10),
              '== Empty ==', chr(10), ': indent', chr(10), '(paren)', chr(10), '---', chr(10),
              '== Last ==', chr(10), '<math>', lang, '</math> and <code>', source, '</code> end....') END AS text
FROM documents"""

#: V3: templates that call each other, three deep, in arguments, defaults and branches; one that calls itself.
NESTED_TEMPLATES = ("N0", "N1", "N2", "N3", "N4", "N5", "String", "N7")
NESTED_PAGES_SQL = """SELECT doc_id AS page_id, CASE WHEN doc_id % 10 = 0 THEN 10 ELSE 0 END AS ns,
       CASE WHEN doc_id % 10 = 0 THEN concat('Template:', CASE CAST(floor(doc_id / 10) AS BIGINT) % 8
              WHEN 0 THEN 'N0' WHEN 1 THEN 'N1' WHEN 2 THEN 'N2' WHEN 3 THEN 'N3' WHEN 4 THEN 'N4' WHEN 5 THEN 'N5' WHEN 6 THEN 'String' ELSE 'N7' END)
            ELSE concat('Doc ', CAST(doc_id AS STRING)) END AS title,
       CAST(NULL AS STRING) AS redirect_title, doc_id + 100000 AS rev_id,
       CASE WHEN doc_id % 10 = 0 THEN CASE CAST(floor(doc_id / 10) AS BIGINT) % 8
              WHEN 0 THEN '({{N1|{{{1}}}|b={{{b|{{N3}}}}}}})'
              WHEN 1 THEN '[{{N2|x={{{1}}}}}{{{b}}}]'
              WHEN 2 THEN '<{{#if:{{{x|}}}|{{{x}}}{{N3}}|none}}>'
              WHEN 3 THEN concat('~', lang)
              WHEN 4 THEN 'r{{N4}}'
              WHEN 5 THEN '{{#switch:{{{1}}}|en=E{{N3}}|de|fr=DF|#default={{N2|x=}}}}'
              WHEN 6 THEN 's{{N7|q}}'
              ELSE '{{#invoke:String|len}}' END
            ELSE concat(CASE doc_id % 10
              WHEN 1 THEN concat('{{N0|', source, '}}')
              WHEN 2 THEN concat('{{N0|', lang, '|b=', source, '}}')
              WHEN 3 THEN concat('{{N5|', lang, '}}{{|x}}')
              WHEN 4 THEN concat('{{N4}}', CASE doc_id % 3 WHEN 0 THEN '' WHEN 1 THEN '{{}}' ELSE '{{}}{{ | }}' END)
              WHEN 5 THEN concat('{{String|', source, '}}{{N7|zz}}')
              WHEN 6 THEN concat('{{subst:N3}}{{ N2 | x = ', source, ' }}')
              WHEN 7 THEN '{{#if: {{N2|x=}} | {{N3}} | {{N4}} }} } {'
              WHEN 8 THEN '{{#if:|{{N4}}|{{N1|q|b=w}}}}'
              ELSE '{{Missing|a}}[[x|y]] {{N1|[[p|q]]|b=[[r|s]]}}' END, ' ', translate(text, '{}|', '   ')) END AS text
FROM documents"""

COMMENTS_SQL = """SELECT conv_id, turn, role,
       concat(CASE WHEN turn % 2 = 0 THEN '*' ELSE '' END,
              '[', role, '](http://e.org/', CAST(conv_id AS STRING), ') &gt; ', text, ' &lt;',
              CASE WHEN turn % 3 = 0 THEN '~' ELSE '' END) AS body
FROM conversations"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; registered as a temp view of the same name."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    df.createOrReplaceTempView(name)
    return df


def wiki_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V1: pages(page_id, ns, title, redirect_title, rev_id, text) in raw dump form."""
    table(spark, sf_dir, "documents")
    return spark.sql(WIKI_PAGES_SQL)


def nested_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V3: the columns of V1, texts as written (nothing to decode), templates that call templates."""
    table(spark, sf_dir, "documents")
    return spark.sql(NESTED_PAGES_SQL)


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V2: comment bodies with Markdown links and escapes."""
    table(spark, sf_dir, "conversations")
    return spark.sql(COMMENTS_SQL)


# Stand-in annotation derived from the text by rule (FIXTURES F5).
POS_CYCLE = ("NOUN", "VERB", "ADJ", "", "PROPN")
DEP_CYCLE = ("amod", "nsubj", "compound", "dobj", "advmod", "det")
ENT_CYCLE = ("", "PERSON", "", "DATE", "", "GPE", "CARDINAL")


def stand_in_annotation(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Tokens (lines = sentences, spaces = tokens) and spans made by position rules.

    ``ent`` spans cover positions 2-3 of every 7 in a sentence, ``np`` spans
    positions 4-5; labels and tags cycle with the token number.
    """
    docs = conversations.select((F.col("conv_id") * 1000 + F.col("turn")).alias("doc_id"), "text")
    sents = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("sent_id", "sent"))
    toks = sents.select("doc_id", "sent_id", (F.size(F.split("sent", " ")) - 1).alias("_last"),
                        F.posexplode(F.split("sent", " ")).alias("k", "text"))
    tok_id = F.col("sent_id") * 100000 + F.col("k")
    arr = lambda xs: F.array(*[F.lit(x) for x in xs])
    tokens = toks.select(
        "doc_id", "sent_id", tok_id.cast("int").alias("tok_id"), "text",
        F.get(arr(POS_CYCLE), (tok_id % len(POS_CYCLE)).cast("int")).alias("pos"),
        F.get(arr(DEP_CYCLE), (tok_id % len(DEP_CYCLE)).cast("int")).alias("dep"),
        F.get(arr(ENT_CYCLE), (tok_id % len(ENT_CYCLE)).cast("int")).alias("ent_type"),
        (F.trim("text") == "").alias("is_space"),
        F.col("text").rlike(r"^(https?://|www\.)").alias("like_url"),
        F.col("k"), F.col("_last"))
    ent = tokens.where((F.col("k") % 7 == 2) & (F.col("k") + 1 <= F.col("_last"))).select(
        "doc_id", F.lit("ent").alias("kind"), F.col("tok_id").alias("start_tok"),
        (F.col("tok_id") + 2).alias("end_tok"),
        F.get(arr(("ORG", "PERSON", "MONEY", "DATE")), (F.col("tok_id") % 4).cast("int")).alias("label"))
    np_ = tokens.where((F.col("k") % 7 == 4) & (F.col("k") + 1 <= F.col("_last"))).select(
        "doc_id", F.lit("np").alias("kind"), F.col("tok_id").alias("start_tok"),
        (F.col("tok_id") + 2).alias("end_tok"), F.lit("").alias("label"))
    return tokens.drop("k", "_last"), ent.unionByName(np_)
