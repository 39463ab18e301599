"""Sources: landed API pages, snapshot envelopes and the table store."""
