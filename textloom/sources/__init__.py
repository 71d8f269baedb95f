from textloom.sources.labelled import load_corpus, load_labelled_csv, load_splits, union_splits, write_labelled_csv
from textloom.sources.lines import line_rows, read_line_files, stream_line_files
from textloom.sources.synthetic import synthetic_corpus

__all__ = [
    "line_rows", "load_corpus", "load_labelled_csv", "load_splits", "read_line_files",
    "stream_line_files", "synthetic_corpus", "union_splits", "write_labelled_csv",
]
