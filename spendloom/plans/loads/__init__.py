"""One module per source: landed files to staging to production."""
