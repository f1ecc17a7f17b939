"""Sources: file formats, stages (directories of files), relational and row sources."""
