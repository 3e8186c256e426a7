"""Readers and decoders: soil tables, tabular XML responses, text reports, catalogues."""
