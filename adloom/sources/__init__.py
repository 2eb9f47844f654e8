"""Where listings, vocabularies and catalogs come from and go to."""
