"""The thin edges: transports, the paged reader, captured responses, the message writer."""
