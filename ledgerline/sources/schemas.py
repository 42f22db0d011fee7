"""Schemas of the raw tables and logs, as they are written."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


#: Header of the record files and the columns it is read into.
RECORD_HEADER = ["Document Number", "Document Type", "Entity Code", "Entity Name", "Vendor", "Amount", "Begin Date", "End Date", "Status", "Detail URL", "View URL"]
RECORD = _strings("doc_number", "doc_type", "entity_code", "entity_name", "vendor", "amount", "begin_date", "end_date", "status", "detail_url", "view_url")
WATCHED = ["amount", "vendor", "begin_date", "end_date"]
FINGERPRINT = ["doc_number", "entity_name", "status", "doc_type", "detail_url"]
TWIN = [c for c in RECORD.names if c != "status"]

DOCUMENTS_LOG = "k string, doc string, entity string, n int, seen string, u string, documents array<struct<name:string,size:string,token:string>>"
TEXT_LOG = (
    "tok string, data struct<status:string,doc:string,pages:int,chars:int,text:string,clipped:boolean,failed_pages:int,parsed_pages:int,parser:string,detail:string,contentType:string,bodySha256:string,bodyHead:string>"
)
SCOPE_LOG = "tok string, doc string, source string, description string, items array<string>"
OCR_LOG = (
    "tok string, doc string, pages int, fetch_error string, render_error string, crash string, fetch_seconds double, render_seconds double, pages_rendered int, "
    "engines map<string,struct<seconds:double,seconds_per_page:double,chars:int,described:boolean,source:string,description:string,text:string,error:string>>"
)
SUMMARY_LOG = "tok string, doc string, model string, seconds double, unclear boolean, summary string, generated_at string, error string"
CHANGE_LOG = "key string, doc string, type string, entity string, field string, `from` string, `to` string, seen string, detail_url string"
#: Append-only enumerations: a code is a place in the list, and places never change.
DESCRIPTION_SOURCES = ["", "line_items", "cover_sheet", "services_clause", "cover_sheet_form", "purchasing_bureau", "direct_purchase", "unknown", "contract_description"]
