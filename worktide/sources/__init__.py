"""Tables, request intake, event outlet and snapshot storage."""
