"""quillbar: nested-document flattening, bar indicators and checked loads as Spark DataFrame functions."""
