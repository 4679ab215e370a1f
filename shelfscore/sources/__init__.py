"""Tables, files and scratch storage."""
