"""The medallion layers and the reports, as DataFrame plans; writes are kept in ``pipeline``."""
