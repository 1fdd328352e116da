"""Schemas of the input and output tables."""

from __future__ import annotations

from pyspark.sql import types as T

LANGUAGE = "eng"
UNIT_TYPES = ("recital", "article", "annex")
RELATION_TYPES = (
    "cites", "amends", "adopts", "based_on", "proposes_to_amend", "consolidates",
)

WORKS = T.StructType([
    T.StructField("celex_id", T.StringType()),
    T.StructField("document_type", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("date_adopted", T.DateType()),
    T.StructField("language", T.StringType()),
    T.StructField("full_text_html", T.StringType()),
])

TEXT_UNITS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("type", T.StringType()),
    T.StructField("number", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("celex_id", T.StringType()),
])

RELATIONS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("celex_source", T.StringType()),
    T.StructField("celex_target", T.StringType()),
    T.StructField("relation_type", T.StringType()),
])

# role: 'main' or 'annex'; fmt: 'xhtml' or 'html'
MANIFESTATIONS = T.StructType([
    T.StructField("celex_id", T.StringType()),
    T.StructField("role", T.StringType()),
    T.StructField("fmt", T.StringType()),
    T.StructField("body", T.StringType()),
])

TRIPLES = T.StructType([
    T.StructField("s", T.StringType()),
    T.StructField("p", T.StringType()),
    T.StructField("o", T.StringType()),
    T.StructField("o_type", T.StringType()),
    T.StructField("datatype", T.StringType()),
    T.StructField("lang", T.StringType()),
])

# Graph predicates -> relation type.
CDM = "http://publications.europa.eu/ontology/cdm#"
RELATION_PREDICATES = {
    CDM + "work_cites_work": "cites",
    CDM + "resource_legal_amends_resource_legal": "amends",
    CDM + "resource_legal_adopts_resource_legal": "adopts",
    CDM + "resource_legal_based_on_resource_legal": "based_on",
    CDM + "resource_legal_proposes_to_amend_resource_legal": "proposes_to_amend",
    CDM + "act_consolidated_consolidates_resource_legal": "consolidates",
}
P_DATE = CDM + "work_date_document"
P_TYPE = CDM + "resource_legal_type"
P_CELEX = CDM + "resource_legal_id_celex"
P_SECTOR = CDM + "resource_legal_id_sector"
P_TITLE = CDM + "expression_title"
P_EXPRESSION_OF = CDM + "expression_belongs_to_work"
P_LANGUAGE = CDM + "expression_uses_language"
P_CONCEPT = CDM + "work_is_about_concept_eurovoc"
P_DOSSIER = CDM + "work_part_of_dossier"
P_REFERENCE = CDM + "procedure_code_interinstitutional_reference_procedure"
P_IN_SCHEME = "http://www.w3.org/2004/02/skos/core#inScheme"
P_PREF_LABEL = "http://www.w3.org/2004/02/skos/core#prefLabel"
P_ALT_LABEL = "http://www.w3.org/2004/02/skos/core#altLabel"
