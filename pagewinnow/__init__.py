"""Web-page extraction and quality jobs on Spark DataFrames."""

from pagewinnow.options import UNLIMITED, ExtractOptions, OptionError
from pagewinnow.plans.extract import extract, ledger, process
from pagewinnow.plans.sweep import option_sweep
from pagewinnow.sources.pages import read_page_tree, read_pages

__version__ = "0.1.0"
__all__ = [
    "ExtractOptions",
    "OptionError",
    "UNLIMITED",
    "extract",
    "ledger",
    "option_sweep",
    "process",
    "read_page_tree",
    "read_pages",
]
