"""Plans: silver star builders (star), gold marts (marts), the end-to-end pipeline
(pipeline) and the mapping of the shared test tables onto the contracts (analogs)."""
