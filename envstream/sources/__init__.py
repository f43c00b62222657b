"""Where rows come from: topics, raw files, name lists, catalogues, tables."""
