"""kvarto: structured-document analytics on PySpark."""
