"""Where rows come from: documents, RAW tables, the zone dimension, request manifests."""
