"""Event streams, CSV folders and snapshot documents."""
