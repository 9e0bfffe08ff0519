"""Square-mile grid analytics on Spark, and operators for text corpora in ``quadrille.llm``."""
