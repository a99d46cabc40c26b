"""quillforge: question-bank and learning-progress analytics on PySpark."""

__version__ = "0.1.0"
