"""Passages, nearest neighbours, queries, briefs and citations."""

from __future__ import annotations

from pyspark.sql import functions as F

from queuecraft.operators import briefs, chunking, embed, explain, retrieval, similarity, triage
from queuecraft.plans import model_queries
from queuecraft.plans import views as V
from queuecraft.plans.registry import query, rounded
from queuecraft.session import staged
from queuecraft.sources import artifacts

# the documents hold no headings or blank lines: their lines serve as paragraphs, "\\n" + capital E as section mark
LINE = "\n"
MARK = "\nE"
HEAD = "E"

_WS = r"[\s\x1c-\x1f\x{85}\p{Z}]+"
_STRIP = lambda c: f"regexp_replace({c}, '^{_WS}|{_WS}$', '', 'g')"


@query("chunk_sections", """
SELECT doc_id, i - 1 AS section_id, CASE WHEN i = 1 THEN s[i] ELSE concat('E', s[i]) END AS section
FROM (SELECT doc_id, string_split(text, chr(10) || 'E') AS s FROM documents), unnest(range(1, len(s) + 1)) t(i)""")
def chunk_sections(spark, sf):
    return chunking.split_sections(V.table(spark, sf, "documents"), "text", "doc_id", MARK, HEAD)


def _pack_sql(secs: str) -> str:
    """Greedy packing of the lines of ``secs`` (doc_id, sec, section), step by step."""
    return f"""
WITH RECURSIVE secs AS ({secs}), long AS (
  SELECT doc_id, sec, string_split(section, chr(10)) AS paras FROM secs WHERE length(section) > 500), steps AS (
  SELECT doc_id, sec, paras, 0 AS at_para, ''::VARCHAR AS open, NULL::VARCHAR AS done FROM long
  UNION ALL
  SELECT doc_id, sec, paras, at_para + 1,
         CASE WHEN at_para >= len(paras) THEN '' WHEN length(open) + length(paras[at_para + 1]) + 1 <= 500 THEN concat(open, paras[at_para + 1], chr(10))
              ELSE concat(paras[at_para + 1], chr(10)) END,
         CASE WHEN at_para >= len(paras) OR length(open) + length(paras[at_para + 1]) + 1 > 500 THEN open END
  FROM steps WHERE at_para <= len(paras)), pieces AS (
  SELECT doc_id, sec, at_para, {_STRIP('done')} AS text FROM steps WHERE done IS NOT NULL
  UNION ALL SELECT doc_id, sec, 0, {_STRIP('section')} FROM secs WHERE length(section) <= 500)
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY sec, at_para) - 1 AS chunk_id, text
FROM pieces WHERE text <> '' OR at_para = 0"""


@query("chunk_pack", _pack_sql("SELECT doc_id, 1 AS sec, text AS section FROM documents"))
def chunk_pack(spark, sf):
    """Whole documents as one section, their lines packed."""
    docs = V.table(spark, sf, "documents").select("doc_id", "text")
    return docs.select("doc_id", F.posexplode(chunking.pack(F.col("text"), mark=LINE)).alias("chunk_id", "text"))


@query("chunk_documents", _pack_sql("""
  SELECT doc_id, i AS sec, CASE WHEN i = 1 THEN s[i] ELSE concat('E', s[i]) END AS section
  FROM (SELECT doc_id, string_split(text, chr(10) || 'E') AS s FROM documents), unnest(range(1, len(s) + 1)) t(i)"""))
def chunk_documents(spark, sf):
    docs = V.table(spark, sf, "documents").select("doc_id", "text")
    return chunking.chunk(docs, "text", "doc_id", section_mark=MARK, heading=HEAD, paragraph_mark=LINE)


N_QUERIES = 10


@query("knn_topk", f"""WITH q AS (SELECT vec_id AS query_id, embedding AS a FROM embeddings WHERE vec_id < {N_QUERIES}), p AS (
  SELECT vec_id AS passage_id, embedding AS b FROM embeddings WHERE vec_id >= {N_QUERIES}), d AS (
  SELECT query_id, passage_id, list_sum(list_transform(list_zip(a, b), lambda x: (x[1]::DOUBLE - x[2]::DOUBLE) * (x[1]::DOUBLE - x[2]::DOUBLE))) AS distance FROM q, p), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, passage_id) AS rank FROM d)
SELECT query_id, passage_id, round(distance, 6) AS distance, rank FROM r WHERE rank <= 5""")
def knn_topk(spark, sf):
    """Ten vectors ask, all the others answer: the query side is small by its role, the passages are all rows."""
    e = V.table(spark, sf, "embeddings")
    queries = e.filter(F.col("vec_id") < N_QUERIES).select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    passages = e.filter(F.col("vec_id") >= N_QUERIES).select(F.col("vec_id").alias("passage_id"), F.col("embedding").alias("vector"))
    return rounded(similarity.knn(queries, passages))


@query("knn_all", """WITH d AS (
  SELECT q.vec_id AS query_id, p.vec_id AS passage_id,
         list_sum(list_transform(list_zip(q.embedding, p.embedding), lambda x: (x[1]::DOUBLE - x[2]::DOUBLE) * (x[1]::DOUBLE - x[2]::DOUBLE))) AS distance
  FROM embeddings q, embeddings p WHERE q.vec_id <> p.vec_id), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, passage_id) AS rank FROM d)
SELECT query_id, passage_id, round(distance, 6) AS distance, rank FROM r WHERE rank <= 5""")
def knn_all(spark, sf):
    """Every vector asks every other one, block against block: the nearest six less itself."""
    e = V.table(spark, sf, "embeddings").withColumnRenamed("embedding", "vector")
    queries = e.select(F.col("vec_id").alias("query_id"), "vector")
    passages = e.select(F.col("vec_id").alias("passage_id"), "vector")
    near = similarity.knn(queries, passages, 6).filter(F.col("query_id") != F.col("passage_id"))
    return rounded(similarity.top_k(near.drop("rank"), 5))


# --- text columns over claims ------------------------------------------------------------------------------

SHOWN = ["BasePolicy", "Fault", "PoliceReportFiled", "WitnessPresent", "VehicleCategory", "AgentType", "AddressChange_Claim", "Deductible"]


def _fields(names):
    return {n: F.col(n) for n in names}


def _reasons():
    """Reason texts from the row's own flags."""
    return F.array_compact(F.array(
        F.when(F.col("PoliceReportFiled") == "No", "[STRONG] High risk: no police report filed [NoPoliceReport] (SHAP: +0.6123)"),
        F.when(F.col("WitnessPresent") == "No", "[MILD] High risk: no witness present [NoWitness] (SHAP: +0.0512)"),
        F.when(F.col("AgentType") == "Internal", "[MODERATE] Low risk: claim handled by an external agent [ExternalAgent] (SHAP: -0.3001)")))


_REASONS = """list_filter([CASE WHEN PoliceReportFiled = 'No' THEN '[STRONG] High risk: no police report filed [NoPoliceReport] (SHAP: +0.6123)' END,
  CASE WHEN WitnessPresent = 'No' THEN '[MILD] High risk: no witness present [NoWitness] (SHAP: +0.0512)' END,
  CASE WHEN AgentType = 'Internal' THEN '[MODERATE] Low risk: claim handled by an external agent [ExternalAgent] (SHAP: -0.3001)' END], lambda x: x IS NOT NULL)"""
_WC = "WITH " + V.CLAIMS + f", rs AS (SELECT *, {_REASONS} AS reasons FROM claims)"


@query("retrieval_query", _WC + """
SELECT PolicyNumber, concat_ws(' ', 'Auto insurance claim analysis.', 'Base policy: ' || BasePolicy || '.', 'Fault: ' || Fault || '.',
  'Police report filed: ' || PoliceReportFiled || '.', 'Witness present: ' || WitnessPresent || '.', 'Vehicle category: ' || VehicleCategory || '.',
  'Agent type: ' || AgentType || '.', 'Address change: ' || AddressChange_Claim || '.', 'Deductible: $' || Deductible || '.',
  CASE WHEN len(reasons) > 0 THEN 'Risk factors identified: ' || array_to_string(list_transform(reasons[1:5], lambda x: '- ' || x), ' ') END) AS query_text FROM rs""")
def retrieval_query(spark, sf):
    c = V.claims(spark, sf)
    return c.select("PolicyNumber", briefs.retrieval_query(_fields(SHOWN), _reasons()).alias("query_text"))


@query("clean_reasons", _WC + """
SELECT PolicyNumber, array_to_string(list_transform(reasons, lambda x: trim(regexp_replace(regexp_replace(x, '^\\[[A-Z]+\\]\\s*', ''), '\\s*\\(SHAP:[^)]*\\)', '', 'g'))), '; ') AS reasons FROM rs""")
def clean_reasons(spark, sf):
    return V.claims(spark, sf).select("PolicyNumber", F.array_join(F.transform(_reasons(), briefs.clean_reason), "; ").alias("reasons"))


def _passages():
    """Two passages out of the claim's own text, to number and cite."""
    return F.array(F.struct(F.lit("rules.md").alias("source"), F.concat(F.lit("Cover: "), F.col("VehicleCategory")).alias("text")),
                   F.struct(F.lit("claims.md").alias("source"), F.concat(F.lit("Holder band "), F.col("MaritalStatus"), F.lit("\n"), F.repeat(F.col("AccidentArea"), 50)).alias("text")))


@query("prompt_text", _WC + """
SELECT PolicyNumber, md5(concat('""" + briefs.PROMPT_OPENING + """', chr(10), chr(10), '## Claim Data', chr(10),
  concat_ws(', ', 'Fault: ' || Fault, 'Deductible: ' || Deductible), chr(10), chr(10), '## Risk Score: ', printf('%.4f', Age / 100.0), chr(10),
  '## Triage Bucket: Manual Review', chr(10), chr(10), '## Machine-Generated Risk Factors (SHAP Analysis)', chr(10),
  array_to_string(list_transform(reasons, lambda x: '- ' || trim(regexp_replace(regexp_replace(x, '^\\[[A-Z]+\\]\\s*', ''), '\\s*\\(SHAP:[^)]*\\)', '', 'g'))), chr(10)),
  chr(10), chr(10), '## Relevant Policy Guidelines', chr(10), '[Source 1: rules.md]', chr(10), 'Cover: ', VehicleCategory, chr(10), chr(10),
  '[Source 2: claims.md]', chr(10), 'Holder band ', MaritalStatus, chr(10), repeat(AccidentArea, 50), chr(10), chr(10),
  '""" + briefs.PROMPT_INSTRUCTIONS.replace("'", "''") + """')) AS digest FROM rs""")
def prompt_text(spark, sf):
    text = briefs.prompt_text(_fields(["Fault", "Deductible"]), F.col("Age") / 100, F.lit(triage.MIDDLE), _reasons(), _passages())
    return V.claims(spark, sf).select("PolicyNumber", F.md5(text).alias("digest"))


def _sql_lines(texts):
    return ", ".join("'" + t.replace("'", "''") + "'" for t in texts)


@query("template_brief", _WC + """, t AS (SELECT *, list_filter(reasons, lambda x: contains(x, 'High risk')) AS hi, list_filter(reasons, lambda x: contains(x, 'Low risk')) AS lo,
    concat('Holder band ', MaritalStatus, ' ', repeat(AccidentArea, 50)) AS p2 FROM rs)
SELECT PolicyNumber, array_to_string(list_concat(
  ['## Triage Brief', concat('**Risk Score:** ', printf('%.4f', Age / 100.0), ' (', CASE WHEN Age >= 50 THEN 'HIGH' WHEN Age >= 30 THEN 'ELEVATED' WHEN Age >= 10 THEN 'MODERATE' ELSE 'LOW' END, ')'),
   concat('**Triage Bucket:** ', CASE WHEN Age > 60 THEN 'SIU' WHEN Age > 40 THEN 'Manual Review' ELSE 'Approve' END), '', '### Risk Assessment'],
  CASE WHEN len(hi) > 0 THEN list_concat([concat('This claim has been flagged with ', len(hi), ' risk indicator(s):')], list_transform(hi, lambda x: '  - ' || x))
       ELSE ['No significant risk indicators were identified for this claim.'] END,
  CASE WHEN len(lo) > 0 THEN list_concat([chr(10) || 'The following factor(s) reduce the overall risk assessment:'], list_transform(lo, lambda x: '  - ' || x)) ELSE [] END,
  ['', '### Claim Details'],
  list_filter([""" + ", ".join(f"'  - **{n}:** ' || {n}" for n in briefs.BRIEF_FIELDS) + """], lambda x: x IS NOT NULL),
  ['', '### Applicable Guidelines', concat('  - [Source 1: rules.md] Cover: ', VehicleCategory),
   concat('  - [Source 2: claims.md] ', trim(p2[1:200]), CASE WHEN length(p2) > 200 THEN '...' ELSE '' END), '', '### Recommended Action'],
  CASE WHEN Age > 60 THEN [""" + _sql_lines(briefs.ACTIONS[triage.TOP]) + """] WHEN Age > 40 THEN [""" + _sql_lines(briefs.ACTIONS[triage.MIDDLE]) + """]
       ELSE [""" + _sql_lines(briefs.ACTION_REST) + """] END), chr(10)) AS brief FROM t""")
def template_brief(spark, sf):
    bucket = F.when(F.col("Age") > 60, triage.TOP).when(F.col("Age") > 40, triage.MIDDLE).otherwise(triage.REST)
    text = briefs.template_brief(_fields([*SHOWN, "Age"]), F.col("Age") / 100, bucket, _reasons(), _passages())
    return V.claims(spark, sf).select("PolicyNumber", text.alias("brief"))


# --- citations: the turns of conversations with citations appended by turn number ---------------------------------

def _cited(spark, sf):
    c = V.table(spark, sf, "conversations")
    tail = F.concat(F.lit(" See [Source "), (F.col("turn") % 7).cast("string"), F.lit("] and [source  "),
                    (F.col("conv_id") % 4 + 1).cast("string"), F.lit(": a.md]."))
    text = F.when(F.col("conv_id") % 5 == 0, F.col("text")).otherwise(F.concat("text", tail))
    return c.select("conv_id", "turn", F.when(F.col("conv_id") % 11 != 0, text).alias("brief"), (F.col("turn") % 5).cast("int").alias("n_passages"))


_CITED = r"""WITH cited AS (
  SELECT conv_id, turn, CASE WHEN conv_id % 11 <> 0 THEN CASE WHEN conv_id % 5 = 0 THEN text ELSE
         concat(text, ' See [Source ', turn % 7, '] and [source  ', conv_id % 4 + 1, ': a.md].') END END AS brief, (turn % 5)::INT AS n
  FROM conversations), nums AS (
  SELECT *, list_sort(list_distinct(list_transform(regexp_extract_all(coalesce(brief, ''), '(?i)\[Source\s+(\d+)', 1), lambda x: x::HUGEINT))) AS cited FROM cited), chk AS (
  SELECT *, list_filter(cited, lambda x: x >= 1 AND x <= n) AS valid, list_filter(cited, lambda x: x < 1 OR x > n) AS invalid FROM nums)"""


def _checked(spark, sf):
    return _cited(spark, sf).withColumn("check", briefs.citation_check(F.col("brief"), F.col("n_passages")))


@query("verify_citations", _CITED + """
SELECT conv_id, turn, array_to_string(cited, ',') AS cited, array_to_string(valid, ',') AS valid, array_to_string(invalid, ',') AS invalid,
       n AS n_passages, len(invalid) = 0 AS ok FROM chk""")
def verify_citations(spark, sf):
    show = lambda name: F.array_join(F.transform(F.col(f"check.{name}"), lambda x: x.cast("string")), ",").alias(name)
    return _checked(spark, sf).select("conv_id", "turn", show("cited"), show("valid"), show("invalid"), "check.n_passages", "check.ok")


@query("annotate_citations", _CITED + r""", marked AS (
  SELECT conv_id, turn, brief, invalid, len(invalid) AS k,
         CASE WHEN len(invalid) >= 1 THEN regexp_replace(brief, '(?i)\[Source\s+' || invalid[1] || '\b', '[UNVERIFIED Source ' || invalid[1], 'g') ELSE brief END AS b1 FROM chk)
SELECT conv_id, turn, CASE WHEN k >= 2 THEN regexp_replace(b1, '(?i)\[Source\s+' || invalid[2] || '\b', '[UNVERIFIED Source ' || invalid[2], 'g') ELSE b1 END AS brief
FROM marked""")
def annotate_citations(spark, sf):
    return _checked(spark, sf).select("conv_id", "turn", briefs.annotate_invalid(F.col("brief"), F.col("check.invalid")).alias("brief"))


@query("citation_caption", _CITED + """
SELECT conv_id, turn, CASE WHEN len(cited) = 0 THEN concat('no citations · ', n, ' passages retrieved')
  WHEN len(invalid) = 0 THEN concat('✅ ', len(valid), '/', len(cited), ' citations verified against ', n, ' retrieved passages')
  ELSE concat('⚠️ ', len(invalid), ' unverified citation(s): [', array_to_string(invalid, ', '), '] — not among the ', n, ' retrieved') END AS caption FROM chk""")
def citation_caption(spark, sf):
    return _checked(spark, sf).select("conv_id", "turn", briefs.citation_caption(F.col("check")).alias("caption"))


# --- retrieval end to end -----------------------------------------------------------------------------------------

def _guidelines(spark, sf):
    """Passages out of the benchmark texts: the short reference corpus that claims are checked against."""
    texts = V.table(spark, sf, "benchmark").select(F.concat(F.lit("item-"), F.col("item_id").cast("string")).alias("source"), "text")
    chunks = chunking.chunk(texts, "text", "source", paragraph_mark=". ")
    return chunks.withColumn("passage_id", F.xxhash64("source", "chunk_id"))


@query("tfidf_vectors")
def tfidf_vectors(spark, sf):
    docs = V.table(spark, sf, "documents").select("doc_id", "text")
    return embed.embed(embed.fit_tfidf(docs), docs).select("doc_id", "vector")


@query("briefs_for_all_claims")
def briefs_for_all_claims(spark, sf):
    """Score, queue and reasons from the fitted scorer, then query text, nearest passages, brief and citation check for
    every claim."""
    passages = staged(_guidelines(spark, sf))
    model = embed.fit_tfidf(passages)
    art = model_queries.fitted_artifacts(spark, sf)
    scored = artifacts.explain_claims(V.claims(spark, sf), art, model_queries.KEY, SHOWN)
    reasons = explain.reasons_array(F.col("contributions"), art.preprocessor.categorical, 3)
    rows = staged(scored.withColumn("reasons", reasons).drop("contributions"))
    out = retrieval.write_briefs(rows, passages, model, _fields(SHOWN), F.col("score"), F.col("bucket"), F.col("reasons"))
    return out.select("PolicyNumber", "query_text", "brief", F.size("passages").alias("n_passages"), F.col("check.ok").alias("citations_ok"))
