"""Schemas at the edges; nothing is inferred."""

from __future__ import annotations

MARK = "struct<present boolean, bbox array<int>, type string>"
FIELDS = f"struct<dealer_name string, model_name string, horse_power double, asset_cost double, signature {MARK}, stamp {MARK}>"
#: One document of the golden file with results.
GOLDEN_RESULT = f"doc_id string, filename string, fields {FIELDS}, error string, confidence double, processing_time_sec double"
GOLDEN_RESULTS = f"metadata struct<total_processed int, successful int, failed int, note string>, results array<struct<{GOLDEN_RESULT}>>"
#: The golden file with ground truth.
GOLDEN_DOCUMENTS = f"documents array<struct<doc_id string, image_path string, ground_truth {FIELDS}, layout_cluster int, annotated_at string, status string>>"
#: Result records: simple, and with sources.
RESULT = f"doc_id string, fields {FIELDS}, confidence double, processing_time_sec double, cost_estimate_usd double"
RESULTS_WITH_SOURCES = (
    "run_id string, timestamp string, total_documents int, source_statistics struct<ocr_fields int, slm_fields int, vlm_fields int>, "
    f"results array<struct<{RESULT}, field_sources map<string,string>>>"
)
#: Detailed records, as the library keeps them.
DETAILED_FIELD = "struct<field_name string, value string, confidence double, calibrated_confidence double, source string, bbox array<int>, metadata map<string,string>>"
DETAILED = f"doc_id string, image_path string, fields map<string,{DETAILED_FIELD}>, document_confidence double, total_cost double, total_latency double, success boolean, errors array<string>, metadata map<string,string>"
#: What an OCR service answers.
OCR_ANSWER = "success boolean, engine string, latency double, error string, results array<struct<text string, bbox_points array<array<double>>, confidence double>>"
OCR_LINE = "doc_id string, engine string, line_no int, text string, bbox array<int>, confidence double"
LONG_VALUE = "doc_id string, field_name string, s string, n double, p boolean, b array<int>"
