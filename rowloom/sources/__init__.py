"""Tables, files and page archives: how rows get in and out."""
