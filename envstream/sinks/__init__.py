"""Where rows go: topics, files, metrics, models."""
