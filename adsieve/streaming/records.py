"""The per-document pipeline on a stream: no state, no watermark, since nothing crosses documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adsieve.functions.cleaning import clean_text, remove_crawl_artifacts
from adsieve.functions.licences import medical_certificates, operating_licences
from adsieve.functions.phones import phones


def extract(documents: DataFrame) -> DataFrame:
    """(doc_id, text, phone_numbers, operating_licenses, medical_certificates) of streamed or stored documents."""
    text = F.col("text")
    clean = documents.select("doc_id", remove_crawl_artifacts(clean_text(text)).alias("text"))
    return clean.select("doc_id", "text", phones(text).alias("phone_numbers"), operating_licences(text).alias("operating_licenses"), medical_certificates(text).alias("medical_certificates"))
