"""Where rows come from: topics, files, tables, the relational target."""
