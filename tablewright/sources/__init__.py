"""Sources and sinks: tables in, predictions and models out."""

from tablewright.sources.tables import (
    PANDAS_NULLS, load_model, read_table, save_model, write_predictions,
)

__all__ = ["PANDAS_NULLS", "load_model", "read_table", "save_model",
           "write_predictions"]
