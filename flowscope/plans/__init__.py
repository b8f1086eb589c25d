"""Named queries over a scale-factor folder (``catalog``) and their SQL twins (``oracle``)."""
