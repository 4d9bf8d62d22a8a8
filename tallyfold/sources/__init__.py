"""Reading and writing files, documents and run history."""
