"""paperloom: document analytics on Spark.

Recognised documents are tables: words, lines, blocks, regions, cells and
exports keyed by document and page.  Everything is expressed as DataFrame plans;
Arrow kernels are used only where an operator is sequential within a page.
"""

__version__ = "0.1.0"
