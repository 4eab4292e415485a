"""Row shapes of the engine, as Spark schemas."""

from __future__ import annotations

from pyspark.sql import types as T

DOCUMENT = T.StructType().add("doc_id", "long").add("text", "string")
SPAN = T.StructType().add("start", "integer").add("end", "integer").add("text", "string").add("labels", T.ArrayType(T.StringType()))
LABELLED_ITEM = T.StructType().add("id", "string").add("text", "string").add("label", T.ArrayType(SPAN))
SENTENCE = T.StructType().add("start", "integer").add("end", "integer").add("text", "string")
CHUNK = T.StructType().add("doc_id", "long").add("chunk_id", "integer").add("chunk_start", "integer").add("chunk_end", "integer").add("text", "string").add("label", T.ArrayType(SPAN))
TOKEN_PREDICTION = (
    T.StructType().add("doc_id", "long").add("chunk_id", "integer").add("i", "integer").add("start", "integer").add("end", "integer").add("label", "string").add("confidence", "double")
)
ENTITY = T.StructType().add("text", "string").add("label", "string").add("start", "integer").add("end", "integer").add("confidence", "double")
NER_RESULT = (
    T.StructType()
    .add("text", "string")
    .add("entities", T.ArrayType(ENTITY))
    .add("entities_by_type", T.MapType(T.StringType(), T.ArrayType(ENTITY)))
    .add("total_entities", "integer")
    .add("entity_types", T.ArrayType(T.StringType()))
)
_NAMES = T.ArrayType(T.StringType())
POSTPROCESSED = T.StructType().add("organization_names", _NAMES).add("addresses", _NAMES).add("persons", _NAMES)
LICENCES = T.StructType().add("operating_licenses", _NAMES).add("medical_certificates", _NAMES)
FINAL_RECORD = (
    T.StructType()
    .add("organization_names", _NAMES)
    .add("addresses", _NAMES)
    .add("doctor_names", _NAMES)
    .add("phone_numbers", _NAMES)
    .add("operating_licenses", _NAMES)
    .add("medical_certificates", _NAMES)
    .add("working_hours", "string")
)
CLEAN_STATS = (
    T.StructType()
    .add("input_file", "string")
    .add("output_file", "string")
    .add("sheets_processed", "integer")
    .add("total_cells", "long")
    .add("changed_cells", "long")
    .add("change_percentage", "double")
)
CELL = T.StructType().add("sheet", "string").add("row", "integer").add("col", "integer").add("value", "string").add("is_text", "boolean")

#: Tags in the order of their ids.
TAGS = ["O", "B-PER", "B-ORG", "B-ADDR", "I-PER", "I-ORG", "I-ADDR"]
TYPES = ["PER", "ORG", "ADDR"]
IGNORED = -100
